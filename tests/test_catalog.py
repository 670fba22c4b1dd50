import pytest
import yaml

from dockhand import catalog as cat


def definition(**changes):
    base = {
        "name": "preise",
        "datei": {"trennzeichen": "|"},
        "spalten": [{"position": 0, "name": "k"}, {"position": 1, "name": "v", "typ": "integer"}],
        "mapping": {
            "regeln": [{"quelle": "k", "ziel": "schluessel"}, {"quelle": "v", "ziel": "wert"}],
            "abgeleitete_felder": [{"ziel": "monat", "funktion": "ladezeitpunkt_jahrmonat"}],
        },
        "zielsystem": {"tabelle": "t", "upsert_key": ["schluessel"]},
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not None}


def test_defaults_and_schema():
    source = cat.source_from_dict(definition(datei=None))
    assert (source.datei.trennzeichen, source.datei.encoding, source.datei.hat_header) == (";", "utf-8", False)
    assert (source.klassifikation.stichprobe_zeilen, source.klassifikation.schwellenwert) == (20, 0.9)
    assert (source.zielsystem.pk_konflikt, source.partial) == ("skip", False)
    assert source.target_schema().simpleString() == "struct<schluessel:string,wert:bigint,monat:string>"


@pytest.mark.parametrize("changes, word", [
    ({"mapping": None}, "mapping"),
    ({"zielsystem": None}, "zielsystem"),
    ({"extra": 1}, "unknown key"),
    ({"datei": {"trenner": "|"}}, "unknown key"),
    ({"spalten": [{"position": 1, "name": "k"}]}, "gapless"),
    ({"spalten": [{"position": 0, "name": "k"}, {"position": 1, "name": "k"}]}, "duplicate"),
    ({"mapping": {"regeln": [{"quelle": "x", "ziel": "z"}]}}, "not defined"),
    ({"zielsystem": {"tabelle": "t", "upsert_key": ["zz"]}}, "not a target"),
    ({"datei": {"trennzeichen": "||"}}, "one character"),
    ({"datei": {"encoding": "utf-16"}}, "not supported"),
    ({"spalten": 5}, "list is expected"),
    ({"spalten": [5]}, "mapping is expected"),
    ({"mapping": []}, "mapping is expected"),
    ({"mapping": {"regeln": "k"}}, "list is expected"),
    ({"zielsystem": "t"}, "mapping is expected"),
    ({"zielsystem": {"tabelle": "t", "upsert_key": "k"}}, "zielsystem.upsert_key"),
    ({"datei": {"hat_header": "perhaps"}}, "datei.hat_header"),
    ({"datei": {"trennzeichen": 5}}, "datei.trennzeichen"),
    ({"klassifikation": {"stichprobe_zeilen": "many"}}, "stichprobe_zeilen"),
    ({"klassifikation": {"stichprobe_zeilen": 2.5}}, "stichprobe_zeilen"),
    ({"name": 5}, "name"),
])
def test_faulty_definitions(changes, word):
    with pytest.raises(cat.CatalogError) as e:
        cat.source_from_dict(definition(**changes))
    assert word in str(e.value)


def test_one_faulty_file_does_not_block_the_others(tmp_path):
    (tmp_path / "preise.yaml").write_text(yaml.safe_dump(definition()))
    (tmp_path / "other.yaml").write_text(yaml.safe_dump(definition(name="renamed")))
    (tmp_path / "bad.yml").write_text("name: [")
    catalog, problems = cat.load_catalog(tmp_path)
    assert list(catalog) == ["preise"] and set(problems) == {"other", "bad"}


def test_faults_of_any_kind_stay_with_their_file(tmp_path, spark):
    good = definition(klassifikation={"stichprobe_zeilen": "20", "schwellenwert": "0.5"}, datei={"trennzeichen": "|", "hat_header": "yes"})
    (tmp_path / "preise.yaml").write_text(yaml.safe_dump(good))
    (tmp_path / "five.yaml").write_text(yaml.safe_dump(definition(name="five", spalten=5)))
    (tmp_path / "text.yaml").write_text("just text")
    (tmp_path / "bytes.yaml").write_bytes(b"name: M\xfcller")
    columns = [{"position": 0, "name": "k", "muster": "(?P<a_b>x)"}, {"position": 1, "name": "v", "typ": "integer"}]
    (tmp_path / "group.yaml").write_text(yaml.safe_dump(definition(name="group", spalten=columns)))
    catalog, problems = cat.load_catalog(tmp_path, spark)
    assert list(catalog) == ["preise"] and set(problems) == {"five", "text", "bytes", "group"}
    assert catalog["preise"].klassifikation.stichprobe_zeilen == 20 and catalog["preise"].datei.hat_header is True
    assert "can't be run" in problems["group"][0]


def test_tables_and_problems(spark):
    tables = cat.catalog_tables(spark, [cat.source_from_dict(definition())])
    assert cat.catalog_problems(tables).count() == 0
    row = cat.catalog_overview(tables).first()
    assert (row["source"], row["n_columns"], row["delimiter"], row["target"]) == ("preise", 2, "|", "t")


def test_single_byte_codecs_are_derived(spark):
    from pyspark.sql import functions as F

    from dockhand.sources import encoding

    data = bytes(range(32, 256))
    frame = spark.createDataFrame([(data,)], "raw binary")
    for codec in ("iso-8859-15", "cp850", "koi8-r", "latin-1"):
        assert encoding.is_supported_encoding(codec)
        row = frame.select(
            encoding.decode_as(F.col("raw"), codec).alias("t"), encoding.undecodable(F.col("raw"), codec).alias("u")
        ).first()
        assert (row["t"], row["u"]) == (data.decode(codec), False)
    assert frame.select(encoding.undecodable(F.col("raw"), "cp1252")).first()[0]
    assert not encoding.is_supported_encoding("shift_jis") and not encoding.is_supported_encoding("no-such")
