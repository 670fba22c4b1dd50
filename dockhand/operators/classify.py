"""Classification: which source does a file come from, judged by its first records.

Every file is scored against every source.  The plan does not grow with the catalog: records
are cut once per dialect (delimiter and encoding), meet the sources of that dialect through
an equi-join, and test their cells against the source's column list as data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dockhand.catalog import CELL_TYPES, Catalog, java_pattern
from dockhand.functions.cells import strip, tokenize, type_fits
from dockhand.functions.text import percent, round_half_even
from dockhand.session import small_table

# Wording of the knock-outs and decisions.
KO_UNREADABLE = "Datei nicht lesbar/leer"
KO_HEADER_ONLY = "Nur Header, keine Datenzeilen"
UNKNOWN, UNSURE, ACCEPTED = "abgelehnt_unbekannt", "abgelehnt_unsicher", "geladen"
REASON_UNKNOWN = "Keine Config passt zu dieser Datei"
SAFE, DOUBTFUL, NO_MATCH = "sicher", "unsicher", "kein_match"

_SOURCES = (
    "source string, catalog_order int, dialect int, width int, has_header boolean, "
    "sample_rows int, threshold double, "
    "columns array<struct<typ:string, pattern:string, required:boolean>>"
)


def dialects(catalog: Catalog) -> list[tuple[str, str]]:
    """Distinct (delimiter, declared encoding) pairs, in catalog order."""
    return list(dict.fromkeys((s.datei.trennzeichen, s.datei.encoding) for s in catalog.values()))


def scoring_table(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """One row per source with all that scoring needs."""
    ids = {d: i for i, d in enumerate(dialects(catalog))}
    rows = [
        (
            s.name, order, ids[s.datei.trennzeichen, s.datei.encoding], s.width,
            s.datei.hat_header, s.klassifikation.stichprobe_zeilen,
            float(s.klassifikation.schwellenwert),
            [(c.typ, None if c.muster is None else java_pattern(c.muster), c.pflicht) for c in s.columns],
        )
        for order, s in enumerate(catalog.values())
    ]
    return small_table(spark, rows, _SOURCES)


def cut_samples(samples: DataFrame, catalog: Catalog, line: dict[str, Column]) -> DataFrame:
    """Cut each sampled record once per dialect: (file, nr, dialect, cells).

    ``line`` maps a declared encoding to the decoded text of a sample row.
    """
    cut = [
        F.struct(
            F.lit(i).alias("dialect"),
            (line[encoding] != "").alias("filled"),
            tokenize(line[encoding], delimiter).alias("cells"),
        )
        for i, (delimiter, encoding) in enumerate(dialects(catalog))
    ]
    return samples.select("file", "nr", F.inline(F.array(*cut))).filter("filled").drop("filled")


def _fits(cell: Column, column: Column) -> Column:
    """Cell test driven by a column definition that is data."""
    typ = F.lit(False)
    for name in CELL_TYPES:
        typ = F.when(column["typ"] == name, type_fits(cell, name)).otherwise(typ)
    pattern = column["pattern"].isNull() | F.rlike(cell, column["pattern"])
    return F.when(cell == "", ~column["required"]).otherwise(typ & pattern)


def score_files(files: DataFrame, cut: DataFrame, sources: DataFrame, catalog: Catalog) -> DataFrame:
    """Score every file against every source: (file, source, score, ko_reason, ...).

    ``files`` lists all files, so an empty one is scored too; its optional array column
    ``unreadable`` holds the dialects that cannot read the file.

    A sampled row meets the sources of its own dialect and width only, so cells are compared with
    what they may fit, however many sources there are.  What the other sources need to know of a
    file follows from how they sample it: its rows, and the width of the first.
    """
    ids = {pair: i for i, pair in enumerate(dialects(catalog))}
    ways = {(ids[s.datei.trennzeichen, s.datei.encoding], s.klassifikation.stichprobe_zeilen, s.datei.hat_header) for s in catalog.values()}
    ways = small_table(files.sparkSession, sorted(ways), "dialect int, sample_rows int, has_header boolean")
    sampled = cut.select("file", "dialect", "nr", F.size("cells").alias("arity"))
    sampled = sampled.join(F.broadcast(ways), "dialect").filter(F.col("nr") <= F.col("sample_rows"))
    data = ~F.col("has_header") | (F.col("nr") > 1)
    profile = sampled.groupBy("file", "dialect", "sample_rows", "has_header").agg(
        F.count(F.lit(1)).alias("n_sampled"),
        F.count_if(data).alias("n_rows"),
        F.min_by("arity", F.when(data, F.col("nr"))).alias("first_arity"),
    )
    met = cut.withColumn("width", F.size("cells")).join(sources, ["dialect", "width"])
    hits = F.size(
        F.filter(F.zip_with(F.transform("cells", lambda cell: strip(cell)), F.col("columns"), _fits), lambda hit: hit)
    )
    fitting = met.filter((F.col("nr") <= F.col("sample_rows")) & data).groupBy("file", "source").agg(
        F.count(F.lit(1)).alias("n_fitting"), F.sum(hits).alias("n_hits")
    )
    pairs = files.select(
        "file",
        *(["unreadable"] if "unreadable" in files.columns else []),
        F.inline(F.array(*(
            F.struct(
                F.lit(s.name).alias("source"), F.lit(order).alias("catalog_order"),
                F.lit(s.width).alias("width"),
                F.lit(ids[s.datei.trennzeichen, s.datei.encoding]).alias("dialect"),
                F.lit(s.klassifikation.stichprobe_zeilen).alias("sample_rows"),
                F.lit(s.datei.hat_header).alias("has_header"),
                F.lit(float(s.klassifikation.schwellenwert)).alias("threshold"),
            )
            for order, s in enumerate(catalog.values())
        ))),
    )
    blocked = (
        F.array_contains("unreadable", F.col("dialect"))
        if "unreadable" in files.columns else F.lit(False)
    )
    ko = (
        F.when(blocked | F.col("n_sampled").isNull(), F.lit(KO_UNREADABLE))
        .when(F.col("n_rows") == 0, F.lit(KO_HEADER_ONLY))
        .when(
            F.col("n_fitting").isNull(),
            F.concat(
                F.lit("Spaltenanzahl "), F.col("first_arity").cast("string"),
                F.lit(" statt "), F.col("width").cast("string"),
            ),
        )
    )
    share = F.try_divide(F.col("n_hits"), F.col("n_fitting") * F.col("width"))
    score = round_half_even(share * F.try_divide(F.col("n_fitting"), F.col("n_rows")))
    return (
        pairs.join(profile, ["file", "dialect", "sample_rows", "has_header"], "left")
        .join(fitting, ["file", "source"], "left")
        .withColumn("ko_reason", ko)
        .withColumn("score", F.when(F.col("ko_reason").isNull(), score).otherwise(F.lit(0.0)))
        .select("file", "source", "catalog_order", "threshold", "score", "ko_reason")
    )


def rank(scores: DataFrame) -> DataFrame:
    """Add ``rank`` (all sources) and ``place`` (sources not knocked out), best first.

    Ties keep catalog order.  Groups hold one row per source.
    """
    order = [F.desc("score"), F.asc("catalog_order")]
    overall = Window.partitionBy("file").orderBy(*order)
    possible = Window.partitionBy("file").orderBy(F.col("ko_reason").isNotNull(), *order)
    return scores.withColumn("rank", F.row_number().over(overall)).withColumn(
        "place", F.when(F.col("ko_reason").isNull(), F.row_number().over(possible))
    )


def decide(
    ranking: DataFrame, require_unambiguous: bool = False, min_lead: float | None = None
) -> DataFrame:
    """One decision per file from its ranking.

    ``decision`` follows the batch rule (best score against the threshold of its source);
    ``category`` the rule for archives, where the runner-up must stay below that threshold
    too or, with ``min_lead``, behind by that much.
    """
    best = F.col("place") == 1
    per_file = ranking.groupBy("file").agg(
        F.max(F.when(best, F.col("source"))).alias("source"),
        F.max(F.when(best, F.col("score"))).alias("score"),
        F.max(F.when(best, F.col("threshold"))).alias("threshold"),
        F.max(F.when(F.col("place") == 2, F.col("score"))).alias("second_score"),
    )
    score, second, threshold = F.col("score"), F.col("second_score"), F.col("threshold")
    if min_lead is None:
        clear = second.isNull() | (second < threshold)
    else:
        clear = second.isNull() | (score - second >= F.lit(min_lead))
    safe = (score >= threshold) & clear
    known = F.col("source").isNotNull()
    accepted = safe if require_unambiguous else score >= threshold
    reason = F.concat(
        F.lit("Kein sicherer Vorschlag (bester Score "), percent(score),
        F.lit(" < Schwellenwert "), percent(threshold), F.lit(")"),
    )
    return per_file.select(
        "file", "source", "score", "threshold", "second_score",
        F.when(~known, F.lit(UNKNOWN)).when(accepted, F.lit(ACCEPTED)).otherwise(F.lit(UNSURE))
        .alias("decision"),
        F.when(~known, F.lit(NO_MATCH)).when(safe, F.lit(SAFE)).otherwise(F.lit(DOUBTFUL))
        .alias("category"),
        F.when(~known, F.lit(REASON_UNKNOWN)).when(~accepted, reason).alias("reason"),
    )


def ranking_lines(ranking: DataFrame) -> DataFrame:
    """Report text per source of an unsure file: (file, rank, text)."""
    text = F.when(
        F.col("ko_reason").isNull(),
        F.concat(F.col("source"), F.lit(": Score "), percent(F.col("score"))),
    ).otherwise(F.concat(F.col("source"), F.lit(": K.O. — "), F.col("ko_reason")))
    return ranking.select("file", "rank", text.alias("text"))
