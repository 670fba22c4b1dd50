"""The catalog: one definition per external source, and the same catalog as tables.

A source definition is plain driver-side metadata (a few hundred small objects).  The
operators use it in two ways: to build column expressions for one source, and as the
small tables of :func:`catalog_tables` where a plan must not grow with the catalog.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.sources.encoding import is_supported_encoding
from dockhand.session import small_table

# Fixed values of the catalog format.
CELL_TYPES = ("string", "integer", "decimal_de", "decimal_en", "date_dmy", "date_iso", "boolean")
NUMERIC_TYPES = ("integer", "decimal_de", "decimal_en")
CONFLICT_MODES = ("skip", "update", "reject")
ERROR_MODES = ("alles_oder_nichts", "partiell")
TARGET_KINDS = ("sqlite", "oracle")
DERIVATIONS = ("ladezeitpunkt_jahrmonat", "ladezeitpunkt_datum", "dateiname")

SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "decimal_de": T.DoubleType(),
    "decimal_en": T.DoubleType(),
    "date_dmy": T.DateType(),
    "date_iso": T.DateType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class ColumnDef:
    """One column of a delivered file, addressed by position."""

    position: int
    name: str
    typ: str = "string"
    muster: str | None = None
    pflicht: bool = True
    minimum: float | None = None
    maximum: float | None = None


@dataclass(frozen=True)
class FileFormat:
    trennzeichen: str = ";"
    encoding: str = "utf-8"
    hat_header: bool = False


@dataclass(frozen=True)
class Sampling:
    stichprobe_zeilen: int = 20
    schwellenwert: float = 0.9


@dataclass(frozen=True)
class Rule:
    quelle: str
    ziel: str
    konvertierung: str | None = None


@dataclass(frozen=True)
class DerivedField:
    ziel: str
    funktion: str


@dataclass(frozen=True)
class Mapping:
    regeln: tuple[Rule, ...]
    abgeleitete_felder: tuple[DerivedField, ...] = ()


@dataclass(frozen=True)
class Target:
    tabelle: str
    typ: str = "sqlite"
    upsert_key: tuple[str, ...] = ()
    pk_konflikt: str = "skip"
    fehler_modus: str = "alles_oder_nichts"


@dataclass(frozen=True)
class SourceDef:
    name: str
    spalten: tuple[ColumnDef, ...]
    mapping: Mapping
    zielsystem: Target
    beschreibung: str = ""
    datei: FileFormat = field(default_factory=FileFormat)
    klassifikation: Sampling = field(default_factory=Sampling)

    @property
    def columns(self) -> list[ColumnDef]:
        return sorted(self.spalten, key=lambda c: c.position)

    @property
    def width(self) -> int:
        return len(self.spalten)

    @property
    def partial(self) -> bool:
        return self.zielsystem.fehler_modus == "partiell"

    def target_fields(self) -> list[str]:
        """Target fields in load order: rules first, then derived fields."""
        names = [r.ziel for r in self.mapping.regeln]
        names += [d.ziel for d in self.mapping.abgeleitete_felder]
        return list(dict.fromkeys(names))

    def target_schema(self) -> T.StructType:
        """Static target schema, taken from the declared cell types."""
        by_name = {c.name: c for c in self.spalten}
        types = {r.ziel: SPARK_TYPES[by_name[r.quelle].typ] for r in self.mapping.regeln}
        for d in self.mapping.abgeleitete_felder:
            types[d.ziel] = T.DateType() if d.funktion == "ladezeitpunkt_datum" else T.StringType()
        return T.StructType([T.StructField(n, types[n]) for n in self.target_fields()])


class CatalogError(ValueError):
    """A source definition that cannot be used; carries every problem found."""

    def __init__(self, problems: list[str]) -> None:
        super().__init__("; ".join(problems))
        self.problems = problems


# Words that the catalog format takes for a flag.
_YES = ("true", "yes", "on", "y", "t", "1", "1.0")
_NO = ("false", "no", "off", "n", "f", "0", "0.0")


def _plain_value(value, kind: str):
    """value as a field of the kind its annotation names; ValueError if it can't be one."""
    if value is None and kind.endswith("| None"):
        return None
    kind = kind.removesuffix(" | None")
    if kind == "str" and isinstance(value, str):
        return value
    if kind == "bool":
        if isinstance(value, bool):
            return value
        word = str(value).lower()
        if isinstance(value, (str, int, float)) and word in _YES + _NO:
            return word in _YES
    if kind in ("int", "float") and isinstance(value, (int, float, str)) and not isinstance(value, bool):
        number = float(value)
        if kind == "float":
            return value if isinstance(value, int) else number
        if number == int(number):
            return int(value) if isinstance(value, (int, str)) and str(value).strip().lstrip("+-").isdigit() else int(number)
    if kind == "tuple[str, ...]" and isinstance(value, (list, tuple)) and all(isinstance(v, str) for v in value):
        return tuple(value)
    raise ValueError(kind)


def _build(cls, raw, where: str, problems: list[str]):
    """Build a dataclass from a mapping, reporting unknown and missing keys and wrong types."""
    if not isinstance(raw, dict):
        problems.append(f"{where}: a mapping is expected")
        return None
    known = {f.name: f for f in fields(cls)}
    problems += [f"{where}: unknown key '{key}'" for key in raw if key not in known]
    values, faulty = {}, False
    for key, value in raw.items():
        if key not in known:
            continue
        try:
            values[key] = _plain_value(value, known[key].type)
        except (ValueError, OverflowError):
            problems.append(f"{where}.{key}: {value!r} is no {known[key].type}")
            faulty = True
    try:
        return None if faulty else cls(**values)
    except TypeError as e:
        problems.append(f"{where}: {e}")
        return None


def _entries(raw, where: str, problems: list[str]) -> list:
    """A list from the file; anything else is a problem, nothing is empty."""
    if raw is None:
        return []
    if isinstance(raw, (list, tuple)):
        return list(raw)
    problems.append(f"{where}: a list is expected")
    return []


def source_from_dict(raw: dict) -> SourceDef:
    """Build one source definition from the nested form of the catalog file."""
    problems: list[str] = []
    if not isinstance(raw, dict):
        raise CatalogError(["a mapping is expected"])
    raw = dict(raw)
    sections = {}
    for key, cls in (("datei", FileFormat), ("klassifikation", Sampling)):
        if key in raw:
            sections[key] = _build(cls, raw.pop(key), key, problems)
    columns = [
        _build(ColumnDef, c, f"spalten[{i}]", problems)
        for i, c in enumerate(_entries(raw.pop("spalten", None), "spalten", problems))
    ]
    mapping = raw.pop("mapping", None)
    if mapping is None:
        problems.append("mapping: section is missing")
    elif not isinstance(mapping, dict):
        problems.append("mapping: a mapping is expected")
    else:
        mapping = dict(mapping)
        rules = [
            _build(Rule, r, "mapping.regeln", problems)
            for r in _entries(mapping.pop("regeln", None), "mapping.regeln", problems)
        ]
        derived = [
            _build(DerivedField, d, "mapping.abgeleitete_felder", problems)
            for d in _entries(mapping.pop("abgeleitete_felder", None), "mapping.abgeleitete_felder", problems)
        ]
        problems += [f"mapping: unknown key '{k}'" for k in mapping]
        mapping = Mapping(tuple(rules), tuple(derived))
    target = raw.pop("zielsystem", None)
    if target is None:
        problems.append("zielsystem: section is missing")
    else:
        if isinstance(target, dict):
            target = dict(target)
            target["upsert_key"] = target.get("upsert_key") or ()
        target = _build(Target, target, "zielsystem", problems)
    name = raw.pop("name", None)
    if not name or not isinstance(name, str):
        problems.append("name: a text is expected")
    text = raw.pop("beschreibung", None) or ""
    problems += [f"unknown key '{k}'" for k in raw]
    if problems:
        raise CatalogError(problems)
    source = SourceDef(name, tuple(columns), mapping, target, text, **sections)
    problems = source_problems(source)
    if problems:
        raise CatalogError(problems)
    return source


def source_problems(source: SourceDef) -> list[str]:
    """Checks on the values of one definition (the table form is :func:`catalog_problems`)."""
    found = []
    cols = source.spalten
    if not cols:
        found.append("spalten: must not be empty")
    if sorted(c.position for c in cols) != list(range(len(cols))):
        found.append(f"spalten: positions must be gapless 0..{len(cols) - 1}")
    names = [c.name for c in cols]
    if len(set(names)) != len(names):
        found.append("spalten: duplicate names")
    for c in cols:
        if c.typ not in CELL_TYPES:
            found.append(f"spalten.{c.name}: unknown type '{c.typ}'")
        if c.muster is not None:
            found += [f"spalten.{c.name}: {p}" for p in pattern_problems(c.muster)]
    if not source.mapping.regeln:
        found.append("mapping.regeln: must not be empty")
    for r in source.mapping.regeln:
        if r.quelle not in names:
            found.append(f"mapping.regeln: column '{r.quelle}' is not defined")
    targets = [r.ziel for r in source.mapping.regeln]
    if len(set(targets)) != len(targets):
        found.append("mapping.regeln: duplicate target")
    for d in source.mapping.abgeleitete_felder:
        if d.funktion not in DERIVATIONS:
            found.append(f"mapping.abgeleitete_felder: unknown function '{d.funktion}'")
    for k in source.zielsystem.upsert_key:
        if k not in source.target_fields():
            found.append(f"zielsystem.upsert_key: '{k}' is not a target field")
    if source.zielsystem.typ not in TARGET_KINDS:
        found.append(f"zielsystem.typ: '{source.zielsystem.typ}' is not known")
    if source.zielsystem.pk_konflikt not in CONFLICT_MODES:
        found.append(f"zielsystem.pk_konflikt: '{source.zielsystem.pk_konflikt}' is not known")
    if source.zielsystem.fehler_modus not in ERROR_MODES:
        found.append(f"zielsystem.fehler_modus: '{source.zielsystem.fehler_modus}' is not known")
    if len(source.datei.trennzeichen) != 1 or source.datei.trennzeichen in '"\r\n':
        found.append("datei.trennzeichen: one character other than a quote is expected")
    if not is_supported_encoding(source.datei.encoding):
        found.append(f"datei.encoding: '{source.datei.encoding}' is not supported")
    if source.klassifikation.stichprobe_zeilen < 1:
        found.append("klassifikation.stichprobe_zeilen: at least 1")
    if not 0 <= source.klassifikation.schwellenwert <= 1:
        found.append("klassifikation.schwellenwert: between 0 and 1")
    return found


def java_pattern(pattern: str) -> str:
    """A pattern in the catalog's dialect (Python's) for Java.

    Classes are read as sets of characters, so a bracket or an ampersand inside one is a plain
    character; named groups and the end of text are written differently.  Flags: classes such as
    ``\\w`` mean Unicode, and only a line feed ends a line.
    """
    out, i, inside, first = [], 0, False, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            out.append("\\z" if pattern[i + 1] == "Z" and not inside else pattern[i : i + 2])
            i, first = i + 2, False
        elif inside:
            if c == "]" and not first:
                inside = False
                out.append(c)
            else:
                out.append("\\" + c if c in "[]&" else c)
            i, first = i + 1, False
        elif c == "[":
            start = "[^" if pattern.startswith("[^", i) else "["
            out.append(start)
            i, inside, first = i + len(start), True, True
        elif pattern.startswith("(?P<", i):
            out.append("(?<")
            i += 4
        elif pattern.startswith("(?P=", i):
            end = pattern.find(")", i)
            out.append(f"\\k<{pattern[i + 4 : end]}>")
            i = end + 1
        else:
            out.append(c)
            i += 1
    # Only classes written as letters differ between ASCII and Unicode, and testing them costs.
    flags = "Ud" if re.search(r"\\[wWdDsSbB]|\(\?", pattern) else "d"
    return f"(?{flags})^(?:{''.join(out)})"


def pattern_problems(pattern: str) -> list[str]:
    """Patterns that the catalog's dialect refuses (see refused_patterns for the JVM)."""
    try:
        re.compile(pattern)
    except re.error as e:
        return [f"pattern is invalid ({e})"]
    return []


def refused_patterns(spark: SparkSession, sources: Iterable[SourceDef]) -> dict[str, list[str]]:
    """Problems by source of patterns that the JVM can't run: each is tried once."""
    problems: dict[str, list[str]] = {}
    for source in sources:
        for c in source.spalten:
            if c.muster is None:
                continue
            try:
                spark.range(1).select(F.col("id").cast("string").rlike(java_pattern(c.muster))).collect()
            except Exception as e:  # whatever the engine says against it, it concerns this source only
                reason = str(e).splitlines()[0][:200]
                problems.setdefault(source.name, []).append(f"spalten.{c.name}: pattern can't be run ({reason})")
    return problems


class Catalog(dict):
    """Usable sources by name, in catalog order (the order breaks ties in the ranking)."""

    @classmethod
    def of(cls, *sources: SourceDef) -> Catalog:
        return cls((s.name, s) for s in sources)

    def delimiters(self) -> list[str]:
        return sorted({s.datei.trennzeichen for s in self.values()})


def load_catalog(folder: str | Path, spark: SparkSession | None = None) -> tuple[Catalog, dict[str, list[str]]]:
    """Read ``*.yaml`` then ``*.yml``; return the usable sources and the problems by file.

    Whatever is wrong with one file stays with that file.  With a session, patterns are also
    tried in the JVM."""
    import yaml

    folder = Path(folder)
    catalog, problems = Catalog(), {}
    for path in sorted(folder.glob("*.yaml")) + sorted(folder.glob("*.yml")):
        try:
            source = source_from_dict(yaml.safe_load(path.read_text(encoding="utf-8")))
        except (CatalogError, yaml.YAMLError, OSError, UnicodeError, ValueError, TypeError) as e:
            problems[path.stem] = getattr(e, "problems", None) or [str(e)]
            continue
        if source.name != path.stem:
            problems[path.stem] = [f"file name does not match name '{source.name}'"]
        else:
            catalog[source.name] = source
    if spark is not None:
        for name, found in refused_patterns(spark, list(catalog.values())).items():
            problems[name] = found
            del catalog[name]
    return catalog, problems


# --- the catalog as tables -----------------------------------------------------------

SOURCES_SCHEMA = (
    "source string, catalog_order int, delimiter string, encoding string, has_header boolean, "
    "width int, sample_rows int, threshold double, target string, target_kind string, "
    "conflict_mode string, error_mode string"
)
COLUMNS_SCHEMA = (
    "source string, position int, name string, typ string, pattern string, required boolean, "
    "minimum double, maximum double"
)
RULES_SCHEMA = "source string, target string, column string"
KEYS_SCHEMA = "source string, key_field string"


@dataclass(frozen=True)
class CatalogTables:
    sources: DataFrame
    columns: DataFrame
    rules: DataFrame
    keys: DataFrame


def catalog_tables(spark: SparkSession, sources: Iterable[SourceDef]) -> CatalogTables:
    """The catalog as four small tables."""
    sources = list(sources)
    head, cols, rules, keys = [], [], [], []
    for order, s in enumerate(sources):
        d, k, z = s.datei, s.klassifikation, s.zielsystem
        head.append((
            s.name, order, d.trennzeichen, d.encoding, d.hat_header, s.width, k.stichprobe_zeilen,
            float(k.schwellenwert), z.tabelle, z.typ, z.pk_konflikt, z.fehler_modus,
        ))
        for c in s.columns:
            lo, hi = (None if b is None else float(b) for b in (c.minimum, c.maximum))
            cols.append((s.name, c.position, c.name, c.typ, c.muster, c.pflicht, lo, hi))
        rules += [(s.name, r.ziel, r.quelle) for r in s.mapping.regeln]
        rules += [(s.name, d.ziel, None) for d in s.mapping.abgeleitete_felder]
        keys += [(s.name, key) for key in z.upsert_key]
    return CatalogTables(
        small_table(spark, head, SOURCES_SCHEMA),
        small_table(spark, cols, COLUMNS_SCHEMA),
        small_table(spark, rules, RULES_SCHEMA),
        small_table(spark, keys, KEYS_SCHEMA),
    )


def position_problems(columns: DataFrame) -> DataFrame:
    """Sources whose positions have gaps or repeats, or whose column names repeat."""
    n = F.count(F.lit(1))
    per_source = columns.groupBy("source").agg(
        n.alias("n"),
        F.min("position").alias("lo"),
        F.max("position").alias("hi"),
        F.count_distinct("position").alias("n_positions"),
        F.count_distinct("name").alias("n_names"),
    )
    gap = (F.col("lo") != 0) | (F.col("hi") + 1 != F.col("n")) | (F.col("n_positions") != F.col("n"))
    checks = F.array(
        F.when(gap, F.lit("POSITION_GAP")),
        F.when(F.col("n_names") != F.col("n"), F.lit("DUPLICATE_NAME")),
    )
    return (
        per_source.select("source", F.explode(checks).alias("problem"))
        .filter(F.col("problem").isNotNull())
        .withColumn("detail", F.lit(None).cast("string"))
    )


def dangling_rules(rules: DataFrame, columns: DataFrame) -> DataFrame:
    """Mapping rules that point to a column the source does not define."""
    known = columns.select("source", F.col("name").alias("column"))
    return (
        rules.filter(F.col("column").isNotNull())
        .join(known, ["source", "column"], "left_anti")
        .select("source", F.lit("DANGLING_RULE").alias("problem"), F.col("column").alias("detail"))
    )


def key_problems(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """Key fields that are no target field."""
    targets = rules.select("source", F.col("target").alias("key_field"))
    return keys.join(targets, ["source", "key_field"], "left_anti").select(
        "source", F.lit("KEY_NOT_A_TARGET").alias("problem"), F.col("key_field").alias("detail")
    )


def duplicate_targets(rules: DataFrame) -> DataFrame:
    """Targets that several column rules of one source write (a derived field may override)."""
    return (
        rules.filter(F.col("column").isNotNull())
        .groupBy("source", "target").count().filter(F.col("count") > 1)
        .select("source", F.lit("DUPLICATE_TARGET").alias("problem"), F.col("target").alias("detail"))
    )


def catalog_problems(tables: CatalogTables) -> DataFrame:
    """Every problem of every source: (source, problem, detail)."""
    return (
        position_problems(tables.columns)
        .unionByName(dangling_rules(tables.rules, tables.columns))
        .unionByName(key_problems(tables.keys, tables.rules))
        .unionByName(duplicate_targets(tables.rules))
    )


def usable_sources(sources: DataFrame, problems: DataFrame) -> DataFrame:
    """Sources without any problem; one faulty definition never blocks the others."""
    return sources.join(problems.select("source"), "source", "left_anti")


def catalog_overview(tables: CatalogTables) -> DataFrame:
    """One line per source: column count, delimiter, header flag, target."""
    width = tables.columns.groupBy("source").agg(F.count(F.lit(1)).alias("n_columns"))
    return tables.sources.join(width, "source", "left").select(
        "source", "n_columns", "delimiter", "has_header", "target"
    )
