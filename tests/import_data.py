"""Sources and deliveries that the tests of the import share."""

from datetime import datetime

from dockhand.catalog import source_from_dict

LOAD_TIME = datetime(2026, 7, 17, 10, 30)


def make_source(name, columns, delimiter="|", header=False, encoding="utf-8", derived=(), **target):
    """A source whose target fields are its columns; columns are dicts without position."""
    target.setdefault("tabelle", name)
    return source_from_dict({
        "name": name,
        "datei": {"trennzeichen": delimiter, "hat_header": header, "encoding": encoding},
        "spalten": [dict(c, position=i) for i, c in enumerate(columns)],
        "mapping": {
            "regeln": [{"quelle": c["name"], "ziel": c["name"]} for c in columns],
            "abgeleitete_felder": [{"ziel": z, "funktion": f} for z, f in derived],
        },
        "zielsystem": target,
    })


READING_COLUMNS = [
    {"name": "geraet", "muster": r"^[a-z]+-\d+$"},
    {"name": "kanal", "typ": "integer", "minimum": 1},
    {"name": "wert", "typ": "decimal_de"},
    {"name": "am", "typ": "date_dmy"},
]

GOOD = """pumpe-1|1|20,5|03.11.2025
pumpe-1|2|1.204,75|03.11.2025
ofen-7|1|-3|24.12.2025
ofen-8|4|0,25|31.1.2026
"""
# A good row, then one fault each: bound, pattern, calendar, number of cells.
FAULTY = """ofen-7|1|99,5|24.12.2025
ofen-7|0|99,5|25.12.2025
Ofen 7|2|99,5|26.12.2025
ofen-7|3|99,5|30.02.2026
ofen-7|4|99,5
"""
UNKNOWN = "4;frei\n9;belegt\n"
