"""Phrase collocations by prefix-free parsing.

A text is cut into words and pieces (at punctuation and line breaks; phrases don't leave a piece)
and parsed into chunks: a chunk ends with a trigger, `longest - 1` words in a row whose hash is 0
modulo TRIGGER, and the next one begins with the same trigger.  So chunks overlap by the trigger
and equal passages fall into equal chunks wherever they stand.  Distinct chunks of a language form
the dictionary, with how often each occurs; phrases are counted inside the dictionary only, each
occurrence times the chunk's frequency.  A phrase belongs to the chunk in which it begins before
the final trigger (the last chunk of a text has all of its own), so overlaps count once.

Phrases are counted by levels.  The dictionary lies in batches, which send the hash of each of
their phrases once to blocks of the hash space (blocks.py); the answer is how often the frequent
ones occur in all.  A phrase can only be frequent if its first and last words are, so from three
words on a batch sends those alone.  The first batch that has a frequent phrase spells it out,
with the frequencies of its cuts, which the same batch knows as well.

Phrases are told apart by 64-bit hashes: among n different ones about n*n/2**65 pairs agree by
chance (0.0001 for 60 million).

Defined cases: a null or empty text has no words; a null language is `und`; repeated rows count
each.  Only the text and the language are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm import blocks as B
from dockhand.llm import words as W
from dockhand.llm.store import record, written

UNKNOWN = "und"
TRIGGER = 32  # words in a chunk, on average

# What ends a piece, and what parts words within one.
ENDS = np.zeros(256, bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
PARTS = ENDS.copy()
PARTS[list(b" \t")] = True
_SPACE, _END = 0x20, 0x0A  # in a chunk one space joins words and one line feed joins pieces
_JOINS = np.zeros(256, bool)
_JOINS[[_SPACE, _END]] = True

CHUNK = record(lang="string", chunk="string", own="int", tail="int", n="long")
PHRASE = record(lang="string", phrase="binary", words="int", a="long", left=T.ArrayType(T.LongType()), right=T.ArrayType(T.LongType()))


def parse(column: pa.Array, overlap: int, trigger: int = TRIGGER) -> Iterator[tuple[int, bytes, int, int]]:
    """(text, chunk, its own words, words at its end that belong to the next one) of all texts."""
    data, offsets = W.utf8(column)
    data = W.LOWER[data]
    words = W.cut(data, offsets, PARTS)
    if not len(words):
        return
    ended = np.concatenate([[0], np.cumsum(ENDS[data])])
    lengths = words.ends - words.starts + 1
    place = np.cumsum(lengths) - lengths
    spelled = data[np.minimum(W.ranges(words.starts, lengths), len(data) - 1)]
    follows = np.append(ended[words.starts[1:]] > ended[words.ends[:-1]], False)  # a piece ends after the word
    spelled[place + lengths - 1] = np.where(follows, _END, _SPACE)
    at = np.flatnonzero(W.whole(words, overlap) & (W.windows(words.hashes(), overlap) % np.uint64(trigger) == 0))
    at = at[~np.isin(at, words.bounds)]  # a text's first chunk begins with it
    starts = np.union1d(at, words.bounds[:-1][words.counts > 0])
    owner = np.searchsorted(words.bounds, starts, "right") - 1
    nexts = np.append(starts[1:], len(words))
    last = np.append(owner[1:] != owner[:-1], True)
    stops = np.where(last, words.bounds[owner + 1], nexts + overlap)
    text = spelled.tobytes()
    low, high = place[starts], (place + lengths - 1)[stops - 1]
    tail = np.where(last, 0, overlap)
    own = stops - tail - starts
    yield from ((d, text[a:b], n, t) for d, a, b, n, t in zip(*(x.tolist() for x in (owner, low, high, own, tail)), strict=True))


def dictionary(docs: DataFrame, lang: Column | str, text: str, overlap: int, trigger: int = TRIGGER) -> DataFrame:
    """Written table of distinct chunks: lang, chunk, own and tail (words), n (occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.sliced(batches, 1):
            langs = batch.column(0).to_pylist()
            found = Counter((langs[d], *chunk) for d, *chunk in parse(batch.column(1), overlap, trigger))
            lang, chunk, own, tail = zip(*found, strict=True) if found else ((),) * 4
            types = (pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.int64())
            arrays = [pa.array(list(c), t) for c, t in zip((lang, chunk, own, tail, found.values()), types, strict=True)]
            arrays[1] = arrays[1].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, CHUNK.names)

    lang = F.coalesce((F.col(lang) if isinstance(lang, str) else lang).cast("string"), F.lit(UNKNOWN))
    rows = docs.select(lang.alias("lang"), F.col(text).cast("string").alias("text")).mapInArrow(run, CHUNK)
    return written(rows.groupBy("lang", "chunk", "own", "tail").agg(F.sum("n").alias("n")), "chunks")


class _Batch:
    """Words of a batch of chunks, and the phrases that begin at each."""

    def __init__(self, table: pa.Table):
        self.data, offsets = W.utf8(table.column("text"))
        self.words = W.cut(self.data, offsets, _JOINS)
        owners = self.words.owners()
        self.langs = table.column("lang").to_pylist()
        seeds = {x: np.uint64(int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest())) for x in set(self.langs)}
        self.hashes = self.words.hashes() ^ np.array([seeds[x] for x in self.langs], np.uint64)[owners]
        self.owners = owners
        ended = np.concatenate([[0], np.cumsum(self.data == _END)])
        self.piece = ended[self.words.starts] + owners if len(self.words) else owners
        n, tail = table.column("n").to_numpy(), table.column("tail").to_numpy()
        own = np.arange(len(self.words)) < (self.words.bounds[1:] - tail)[owners]
        self.times = np.where(own, n[owners], 0)

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of this size begin, and their hashes."""
        n = len(self.words) - size + 1
        at = np.flatnonzero(self.piece[: max(n, 0)] == self.piece[size - 1 :]) if n > 0 else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            return at, W.mix(W.windows(self.hashes, size)[at] + np.uint64(size))


class _Level:
    """Distinct phrases of some sizes in one batch, and which place has which."""

    def __init__(self, batch: _Batch, sizes: list[int], frequent: np.ndarray | None):
        """frequent: at which words a frequent phrase of one word less begins."""
        self.n_words, self.at, keys = len(batch.words), [], []
        for size in sizes:
            at, hashes = batch.phrases(size)
            if frequent is not None:
                keep = frequent[at] & frequent[at + 1]
                at, hashes = at[keep], hashes[keep]
            self.at.append(at)
            keys.append(hashes)
        self.sizes = sizes
        self.keys, self.example, kind = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        self.kind = np.split(kind, np.cumsum([len(a) for a in self.at])[:-1])
        times = batch.times[np.concatenate(self.at)]
        self.times = np.zeros(len(self.keys), np.int64)
        np.add.at(self.times, kind, times)

    def frequent(self, total: np.ndarray) -> np.ndarray:
        """Whether a frequent phrase of the largest size begins at each word."""
        out = np.zeros(self.n_words + 1, bool)
        out[self.at[-1]] = total[self.kind[-1]] > 0
        return out

    def told(self, right: pa.Table, level: int, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences in all of each frequent key (else 0), and whether this batch spells it out."""
        edges, total, mine = B.cuts(self.keys, n_blocks), np.zeros(len(self.keys), np.int64), np.zeros(len(self.keys), bool)
        for l, block, found in zip(*(right.column(k).to_pylist() for k in ("level", "block", "found")), strict=True):
            if l == level:
                low, high = int(edges[block]), int(edges[block + 1])
                bits = -(-(high - low) // 8)
                hit = low + np.flatnonzero(np.unpackbits(np.frombuffer(found, np.uint8, bits), count=high - low))
                more = bits + -(-len(hit) // 8)
                mine[hit] = np.unpackbits(np.frombuffer(found, np.uint8, more - bits, bits), count=len(hit))
                total[hit] = B.unplanes(found[more:], np.int64)
        return total, mine


def _levels(batch: _Batch, right: pa.Table | None, known: int, n_blocks: int) -> Iterator[tuple[_Level, np.ndarray, np.ndarray]]:
    """The levels whose answers are known: one and two words, three words, four words..."""
    frequent = None
    for level in range(known):
        here = _Level(batch, _sizes(level), frequent)
        total, mine = here.told(right, level, n_blocks)
        yield here, total, mine
        frequent = here.frequent(total)


def _sizes(level: int) -> list[int]:
    return [1, 2] if level == 0 else [level + 2]


def _ask(level: int, n_blocks: int):
    """What a batch sends at a level, after the answers to those before."""

    def run(left: pa.Table, right: pa.Table | None) -> pa.Table:
        out = []
        for number, payload in zip(left.column("batch").to_pylist(), left.column("payload"), strict=True):
            batch, frequent = _Batch(B.unseal(payload)), None
            for before, total, _ in _levels(batch, right, level, n_blocks):
                frequent = before.frequent(total)
            here = _Level(batch, _sizes(level), frequent)
            out += B.send(number, here.keys, n_blocks, lambda part, times=here.times: B.planes(times[part]))
        return pa.Table.from_batches(out, _arrow(B.KEYS))

    return run


def _ask_first(n_blocks: int):
    ask = _ask(0, n_blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from ask(pa.Table.from_batches([batch.slice(i, 1)]), None).to_batches()

    return run


def _arrow(kind: T.StructType) -> pa.Schema:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(f.name, types[f.dataType.simpleString()]) for f in kind.fields])


def _sum_up(least: int):
    """For each batch: which of its keys are frequent, which of these it spells out, and how often
    they occur in all."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("batch")
        keys = [B.received(x) for x in rows.column("keys").to_pylist()]
        times = np.concatenate([B.unplanes(x, np.int64) for x in rows.column("values").to_pylist()])
        order, head, group = B.grouped(keys)
        total = np.add.reduceat(times[order], head)[group]
        first = np.zeros(len(group), bool)
        first[order[head]] = True  # the order is stable, so this is the first batch
        out, at = [], 0
        for k in keys:
            part = slice(at, at + len(k))
            hit = total[part] >= least
            out.append(np.packbits(hit).tobytes() + np.packbits(first[part][hit]).tobytes() + B.planes(total[part][hit]))
            at += len(k)
        return B.answer(rows, out)

    return run


def _spell(longest: int, n_blocks: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        for payload in left.column("payload"):
            batch = _Batch(B.unseal(payload))
            at_word = {}  # size: occurrences in all of the frequent phrase that begins at each word
            for here, total, mine in _levels(batch, right, longest - 1, n_blocks):
                for size, at, kind in zip(here.sizes, here.at, here.kind, strict=True):
                    at_word[size] = np.zeros(len(batch.words) + 1, np.int64)
                    at_word[size][at] = total[kind]
                    if size > 1:
                        _, example = np.unique(kind, return_index=True)
                        chosen = example[mine[kind[example]]]
                        i = at[chosen]
                        left_of = [at_word[k][i].tolist() for k in range(1, size)]
                        right_of = [at_word[size - k][i + k].tolist() for k in range(1, size)]
                        low, high = batch.words.starts[i].tolist(), batch.words.ends[i + size - 1].tolist()
                        spelled = [batch.data[a:b].tobytes() for a, b in zip(low, high, strict=True)]
                        langs = [batch.langs[o] for o in batch.owners[i].tolist()]
                        cuts = zip(zip(*left_of, strict=True), zip(*right_of, strict=True), strict=True)
                        rows += [
                            (lang, phrase, size, a, list(l), list(r))
                            for lang, phrase, a, (l, r) in zip(langs, spelled, total[kind[chosen]].tolist(), cuts, strict=True)
                        ]
        schema = _arrow(PHRASE)
        columns = list(zip(*rows, strict=True)) or [()] * len(schema)
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def frequent(docs: DataFrame, lang: Column | str, text: str, longest: int, least: int, trigger: int = TRIGGER, batch_bytes: int = B.BATCH_BYTES, block_keys: int = B.BLOCK_KEYS // 2) -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to `longest` words that occur `least` times or more (lang, phrase, words, a
    and, for each cut, the occurrences of both parts), and (lang, n): words of each language."""
    chunks = dictionary(docs, lang, text, longest - 1, trigger)
    sizes = chunks.groupBy("lang").agg(F.sum(F.col("own").cast("bigint") * F.col("n")).alias("n"))
    batches = B.pack(chunks.withColumn("doc_id", F.lit(None).cast("bigint")), "chunk", {k: F.col(k) for k in ("lang", "tail", "n")}, batch_bytes)
    n_blocks = B.count_blocks(batches, block_keys)
    found = None
    for level in range(longest - 1):
        if found is None:
            keys = batches.mapInArrow(_ask_first(n_blocks), B.KEYS)
        else:
            keys = batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(_ask(level, n_blocks), B.KEYS)
        answers = keys.groupBy("block").applyInArrow(_sum_up(least), B.FOUND).withColumn("level", F.lit(level))
        answers = written(answers, "phrase-counts", compression="none")
        found = answers if found is None else found.unionByName(answers)
    phrases = batches.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(_spell(longest, n_blocks), PHRASE)
    return written(phrases.withColumn("phrase", F.col("phrase").cast("string")), "phrases"), sizes


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(10**6 * a * a / (l * r)), exact for counts up to 10**15."""
    a, l, r = (x.cast("decimal(15,0)") for x in (a, l, r))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * a * a, l * r)


def collocations(
    docs: DataFrame, lang: Column | str = "lang", text: str = "text", longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000,
    trigger: int = TRIGGER, batch_bytes: int = B.BATCH_BYTES, block_keys: int = B.BLOCK_KEYS // 2,
) -> DataFrame:
    """lang, rank, phrase, words, a, l, r, n and score of the `top` best phrases of each language:
    by score and a, descending, then by phrase.

    A phrase is left out if it lies in a longer frequent one with at least `covered` percent of its
    occurrences.  The score is floor(10**6 * a * a / (l * r)) of the cut that makes it smallest, the
    earliest of these."""
    phrases, sizes = frequent(docs, lang, text, longest, least, trigger, batch_bytes, block_keys)
    inner = F.expr("""flatten(transform(sequence(2, words - 1),
        size -> transform(sequence(1, words - size + 1), i -> array_join(slice(split(phrase, ' '), i, size), ' '))))""")
    longer = phrases.where("words > 2").select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left_out = F.coalesce(100 * F.col("longer").cast("decimal(19,0)") >= covered * F.col("a").cast("decimal(19,0)"), F.lit(False))
    phrases = phrases.join(most, ["lang", "phrase"], "left").where(~left_out)
    cuts = F.transform(
        F.arrays_zip("left", "right"),
        lambda c, k: F.struct(_score(F.col("a"), c["left"], c["right"]).alias("score"), k.alias("k"), c["left"].alias("l"), c["right"].alias("r")),
    )
    scored = phrases.select("lang", "phrase", "words", "a", F.array_min(cuts).alias("cut")).select("lang", "phrase", "words", "a", "cut.score", "cut.l", "cut.r")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "words", "a", "l", "r", "n", "score")
