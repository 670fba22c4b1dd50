"""Queries opN_<name>: each operator with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.llm import (
    chat, collocations, contamination, fingerprints, language, licenses, minhash, mixing, pii, resampling, scoring, substrings, vectors,
)
from dockhand.llm.store import bounded

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PII_KEY = b"a secret that the caller keeps; this one only serves the query"

# The tree of the mixture: sources by domain, weights by level.
DOMAINS = {"web": range(5), "books": range(5, 10), "forum": range(10, 15), "news": range(15, 20)}
WEIGHTS = mixing.Weights(
    domains={"web": 3, "books": 3, "forum": 2, "news": 2}, languages={"en": 5, "de": 2, "fr": 2, "es": 2},
    sources={"src0": 4},
)
MIX = {"share": 0.75, "max_epochs": 4, "seed": 20240229}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def domain(source: str = "source") -> Column:
    names = F.create_map(*[F.lit(x) for k, v in DOMAINS.items() for i in v for x in (f"src{i}", k)])
    return F.coalesce(names[F.col(source)], F.lit("other"))


@query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out("doc_id", 5, 0))
    model = language.fit(docs.where(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op2_license_scan(spark, sf_dir):
    found = licenses.scan(table(spark, sf_dir, "documents"))
    words = F.transform("places", lambda p: p["word"])
    base = F.array_distinct(F.transform("places", lambda p: p["label"]))
    every = F.array_union(base, F.transform("matches", lambda m: m["label"]))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"),
        "score", F.size("matches").cast("bigint").alias("n_matches"),
    )


@query
def op3_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymize(docs, PII_KEY, found="found")
    kinds = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["kind"])))
    return found.select("doc_id", "text", F.size("found").cast("bigint").alias("n_found"), F.array_join(kinds, ",").alias("kinds"), "found")


@query
def op4_substring_dedup(spark, sf_dir):
    found = substrings.deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_embedding_dedup(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op6_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("bigint"), "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    chats = chat.format_chats(turns.unionByName(extra))
    chats = chats.select("conv_id", "formatted", "valid", chat.learned(F.col("segments")).alias("learned"))
    chats = chats.withColumn("turns", chat.read_back(F.col("formatted")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), "valid",
    )


@query
def op7_lm_scoring(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = language.held_out("doc_id", 7, 2)
    found = scoring.score(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op8_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    mixed = mixing.mix(docs, WEIGHTS, domain=domain(), **MIX)
    return mixed.select("doc_id", "domain", "language", "origin", "epoch", "n_tokens", "taken")


@query
def op9_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=2)


@query
def op10_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.matches(docs, table(spark, sf_dir, "benchmark"), found="spans")
    items = F.array_sort(F.array_distinct(F.transform("spans", lambda x: x["item_id"])))
    longest = F.coalesce(F.array_max(F.transform("spans", lambda x: x["length"])), F.lit(0))
    return found.select("doc_id", (F.size("spans") > 0).alias("contaminated"), items.alias("item_ids"), longest.alias("longest"), "spans")


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("words")


@query
def op12_resampling(spark, sf_dir):
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_fingerprints(spark, sf_dir):
    found = fingerprints.edit_next(table(spark, sf_dir, "documents"))
    text = {k: F.lower(F.hex(k)) for k in ("fingerprint", "edited_fingerprint")}
    return found.select("doc_id", "n_chars", "edited_sha256", *[c.alias(k) for k, c in text.items()], "near_edited", "near_next")


def _escaped_length(text: str) -> str:
    """Length of a text after escaping: one character more for each backslash and control string."""
    controls = ("\\", *chat.TEMPLATE.control)
    counts = " + ".join(f"(length({text}) - length(replace({text}, '{c}', ''))) // {len(c)}" for c in controls)
    return f"(length({text}) + {counts})"


def _chat_sql() -> str:
    t = chat.TEMPLATE
    marks = {role: len(x.open) + len(x.close) for role, x in t.turns.items()}
    other = len(t.other_open) + len(t.other_name) + len(t.other_close)
    length = "CASE role " + " ".join(f"WHEN '{r}' THEN {n}" for r, n in marks.items())
    length += f" ELSE {other} + {_escaped_length('role')} END + {_escaped_length('text')}"
    order = "ORDER BY turn NULLS FIRST, role, text"
    return f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' {order}) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({length}) AS BIGINT) AS formatted_chars,
  regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END, '' {order}),
    's?(ua)+') AS valid
FROM said GROUP BY conv_id"""


def _mixing_sql() -> str:
    domains = " ".join(f"WHEN 'src{i}' THEN '{k}'" for k, v in DOMAINS.items() for i in v)
    tables = (WEIGHTS.domains, WEIGHTS.languages, WEIGHTS.sources)
    steps, above = [], "SELECT (SELECT least(CAST(floor(sum(n_tokens) * {share}) AS BIGINT), sum(n_tokens) * {max_epochs}) FROM d) AS share".format(**MIX)
    steps.append(f"level0 AS ({above})")
    for level, known in enumerate(tables, 1):
        here, parents = list(mixing.LEVELS[:level]), list(mixing.LEVELS[: level - 1])
        weight = f"CASE {here[-1]} " + " ".join(f"WHEN '{k}' THEN {w}" for k, w in known.items()) + f" ELSE {WEIGHTS.default} END"
        group = f"PARTITION BY {', '.join(parents)}" if parents else ""
        order = f"{group} ORDER BY CAST(capacity AS DOUBLE) / weight, {here[-1]}"
        join = f"JOIN level{level - 1} USING ({', '.join(parents)})" if parents else "CROSS JOIN level0"
        steps.append(f"""level{level} AS (
  WITH nodes AS (SELECT {', '.join(here)}, sum(n_tokens) * {MIX['max_epochs']} AS capacity, {weight} AS weight FROM d GROUP BY {', '.join(here)}),
  placed AS (SELECT nodes.*, share AS budget,
      coalesce(sum(capacity) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
    FROM nodes {join}),
  judged AS (SELECT *, capacity * open_weight <= weight * (budget - before) AS filled FROM placed),
  summed AS (SELECT *, sum(CASE WHEN filled THEN capacity ELSE 0 END) OVER ({group}) AS used,
      sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({group}) AS rest FROM judged)
  SELECT {', '.join(here)}, CASE WHEN filled THEN capacity ELSE (weight * (budget - used)) // rest END AS share FROM summed)""")
    return f"""
WITH d AS (
  SELECT doc_id, CASE source {domains} ELSE 'other' END AS domain, coalesce(lang, 'unknown') AS language,
    coalesce(source, 'unknown') AS origin, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_tokens
  FROM documents WHERE regexp_matches(text, '[^\x20\x09-\x0D]')
),
{', '.join(steps)},
leaves AS (
  SELECT domain, language, origin, share // tokens AS epochs, share % tokens AS goal
  FROM level3 JOIN (SELECT domain, language, origin, sum(n_tokens) AS tokens FROM d GROUP BY ALL) USING (domain, language, origin)
),
whole AS (SELECT doc_id, domain, language, origin, unnest(range(CAST(epochs AS BIGINT))) AS epoch, n_tokens, n_tokens AS taken
  FROM d JOIN leaves USING (domain, language, origin)),
running AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, language, origin
    ORDER BY md5('{MIX['seed']}:' || CAST(epochs AS BIGINT) || ':' || doc_id)) - n_tokens AS before
  FROM d JOIN leaves USING (domain, language, origin))
SELECT doc_id, domain, language, origin, epoch, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(taken AS BIGINT) AS taken FROM whole
UNION ALL SELECT doc_id, domain, language, origin, CAST(epochs AS BIGINT), CAST(n_tokens AS BIGINT),
  CAST(least(n_tokens, goal - before) AS BIGINT) FROM running WHERE before < goal"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _collocations_sql() -> str:
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(text, '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
),
cut AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w)) AS n FROM cut GROUP BY lang),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM cut
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM cut
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM cut
),
counts AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS f FROM grams GROUP BY ALL),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
longer AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE k = 3) GROUP BY ALL
),
cuts AS (
  SELECT lang, phrase, a, 1 AS place, w[1] AS head, array_to_string(w[2:], ' ') AS rest FROM candidates
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3
),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, place, l.f AS l, r.f AS r, 1000000 * a * a // (l.f * r.f) AS score
  FROM cuts JOIN counts l ON l.lang = cuts.lang AND l.phrase = cuts.head JOIN counts r ON r.lang = cuts.lang AND r.phrase = cuts.rest
    LEFT JOIN longer ON longer.lang = cuts.lang AND longer.phrase = cuts.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""


def _resampling_sql() -> str:
    """CRC-32 is worked out byte by byte, from a table that is made in the query."""
    p = resampling.Plan()
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    rounds = ["r0 AS (SELECT range AS i, CAST(range AS BIGINT) AS c FROM range(256))"]
    rounds += [f"r{k} AS (SELECT i, {step} AS c FROM r{k - 1})" for k in range(1, 9)]
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT {words} AS w FROM benchmark),
spelled AS (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
{', '.join(rounds)},
bytes AS (SELECT word, hex(encode(word)) AS x FROM spelled),
hashed AS (
  SELECT word, xor(list_reduce(
      list_transform(range(0, len(x) // 2), lambda i: CAST(CAST('0x' || x[2 * i + 1:2 * i + 2] AS INT) AS BIGINT)),
      lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % {p.buckets} AS bucket
  FROM bytes, (SELECT list(c ORDER BY i) AS t FROM r8)
),
of_documents AS (SELECT bucket, count(*) AS s FROM (SELECT unnest(w) AS word FROM d) JOIN hashed USING (word) GROUP BY bucket),
of_target AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS word FROM b) JOIN hashed USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT sum(len(w)) FROM d) AS all_s, coalesce((SELECT sum(len(w)) FROM b), 0) AS all_t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(all_s + {p.buckets} AS DOUBLE))
    / (CAST(s + 1 AS DOUBLE) * CAST(all_t + {p.buckets} AS DOUBLE)))) AS BIGINT) AS gain
  FROM of_documents LEFT JOIN of_target USING (bucket), totals
),
summed AS (
  SELECT doc_id, sum(gain) AS gain FROM (SELECT doc_id, unnest(w) AS word FROM d) JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY doc_id
),
weighed AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(floor(CAST(gain AS DOUBLE) / len(w)), 0) AS BIGINT) AS weight,
    CAST('0x' || sha256('{p.seed}:' || doc_id)[1:8] AS BIGINT) AS h
  FROM d LEFT JOIN summed USING (doc_id)
),
scored AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM weighed),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE n_features >= {p.least_words}
)
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT * FROM drawn WHERE rank <= (SELECT {p.percent} * count(*) // 100 FROM drawn)) USING (doc_id)"""


#: DuckDB SQL for the queries that SQL can express; the others are tested against brute force.
SQL: dict[str, str] = {
    "op6_chat_format": _chat_sql(), "op8_mixing": _mixing_sql(), "op11_collocations": _collocations_sql(), "op12_resampling": _resampling_sql(),
}
