"""A small hand-made set of exports with each kind of defect, and what must come of it."""

import json
from datetime import date, datetime, timedelta

AREA_OF = {"deCases": "HIV", "dePosit": "HIV", "deStock": "HIV", "deOther": None}
INDICATORS = [
    {"id": "deCases", "name": "Cases", "valueType": "INTEGER_ZERO_OR_POSITIVE", "groups": ["HIV", "All"]},
    {"id": "dePosit", "name": "Positivity", "valueType": "PERCENTAGE", "groups": ["HIV"]},
    {"id": "deStock", "name": "In stock", "valueType": "BOOLEAN", "groups": ["HIV"]},
    {"id": "deOther", "name": "Other", "valueType": "TEXT", "groups": []},
]
CATEGORIES = [{"id": "cocMain", "name": "default"}, {"id": "cocKids", "name": "under 5"}]
# id, name, level, path
TREE = [
    ("alpha", "Alpha", 1, "/alpha"),
    ("alphaR", "Alpha North", 2, "/alpha/alphaR"),
    ("alphaD", "Alpha Hills", 3, "/alpha/alphaR/alphaD"),
    ("facA", "Clinic A", 4, "/alpha/alphaR/alphaD/facA"),
    ("facB", "Clinic B", 4, "/alpha/alphaR/alphaD/facB"),
    ("beta", "Beta", 1, "/beta"),
    ("betaD", "Beta Coast", 3, "/beta/lostR/betaD"),
    ("facC", "Clinic C", 4, "/beta/lostR/betaD/facC"),
]
FACILITIES = {
    "facA": ("Clinic A", "Alpha Hills", "Alpha North", "Alpha"),
    "facB": ("Clinic B", "Alpha Hills", "Alpha North", "Alpha"),
    "facC": ("Clinic C", "Beta Coast", None, "Beta"),
}
PROGRAMS = [
    {"id": "pgAlpha", "name": "HIV Alpha", "country": "Alpha", "dataElements": ["deCases", "dePosit", "deStock"]},
    {"id": "pgBeta", "name": "HIV Beta", "country": "Beta", "dataElements": ["deCases", "dePosit", "deNever", "deStock"]},
]
MONTHS = ["202311", "202312", "202401", "202402"]


def month_end(period):
    year, month = int(period[:4]), int(period[4:])
    return date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)


def value(element, period, unit, text, category="cocMain", days=10, created="2023-01-01", by="User.ONE"):
    updated = datetime.combine(month_end(period), datetime.min.time()) + timedelta(days=days)
    return {
        "dataElement": element, "period": period, "orgUnit": unit, "categoryOptionCombo": category,
        "attributeOptionCombo": "aocMain", "value": text, "storedBy": by,
        "created": f"{created}T00:00:00.000", "lastUpdated": updated.strftime("%Y-%m-%dT%H:%M:%S.000"),
        "followup": "false",
    }


def data_values(months=MONTHS):
    rows = []
    for i, month in enumerate(months):
        for unit, base in (("facA", 10), ("facB", 20), ("facC", 30)):
            rows.append(value("deCases", month, unit, str(base + i)))
            rows.append(value("dePosit", month, unit, f"{base + i}.5"))
            if unit != "facC":
                rows.append(value("deStock", month, unit, "true"))
        rows.append(value("deCases", month, "facA", "0", category="cocKids"))
        rows.append(value("deCases", month, "facB", "0.0", category="cocKids", days=60))
        rows.append(value("deCases", month, "facC", None, category="cocKids", days=61))
        rows.append(value("deCases", month, "facA", str(99 + i), days=20))  # a later correction
        rows.append(value("deCases", month, "facA", str(99 + i), days=20))  # and its exact copy
        rows.append(value("dePosit", month, "facB", "junk", category="cocKids"))
        rows.append(value("deGhost", month, "facA", "5"))
        rows.append(value("deCases", month, "ghostUnit", "6"))
        rows.append(value("deCases", month, "alphaD", "7"))  # a district, not a facility
        rows.append(value("deCases", month, "facA", "8", category="cocGhost"))
        rows.append(value("deCases", month, "facA", "9", category=None))
        rows.append(value("deOther", month, "facA", "note"))
    return rows


def malformed_values():
    return [
        {**value("deCases", "202401", "facA", "1"), "period": "2024-1"},
        {**value("deCases", "202401", "facA", "1"), "period": None},
        {**value("deCases", "202401", "facA", "1"), "orgUnit": None},
    ]


def write_exports(folder, rows, indicators=INDICATORS, pretty=False):
    folder.mkdir(parents=True, exist_ok=True)
    documents = {
        "data_values.json": {"responseType": "DataValueSet", "version": "1", "dataValues": rows},
        "metadata.json": {
            "dataElements": [
                {"id": i["id"], "name": i["name"], "valueType": i["valueType"],
                 "dataElementGroups": [{"id": g.lower(), "name": g} for g in i["groups"]],
                 "categoryCombo": {"id": "cc", "name": "combo"}, "zeroIsSignificant": True}
                for i in indicators
            ],
            "categoryOptionCombos": CATEGORIES,
        },
        "org_units.json": {
            "organisationUnits": [
                {"id": i, "name": n, "level": level, "path": path, "groups": [{"id": "g", "name": "Public"}, {"id": "h", "name": "Urban"}]}
                for i, n, level, path in TREE
            ]
        },
        "programs.json": {"programs": [{**p, "healthArea": "HIV"} for p in PROGRAMS]},
    }
    for name, document in documents.items():
        (folder / name).write_text(json.dumps(document, indent=2 if pretty else None))
    return str(folder)


def expected_fact(rows):
    """The fact of ``rows`` by plain loops, as a dict from key to the values worth checking."""
    latest = {}
    for r in rows:
        key = (r["dataElement"], r["period"], r["orgUnit"], r["categoryOptionCombo"])
        if key not in latest or r["lastUpdated"] > latest[key]["lastUpdated"]:
            latest[key] = r
    kinds = {i["id"]: i["valueType"] for i in INDICATORS}
    names = {i["id"]: i["name"] for i in INDICATORS}
    reported = {}
    for (element, period, unit, _), _row in latest.items():
        if element in names:
            group = (FACILITIES.get(unit, (None,) * 4)[3], AREA_OF[element], unit, period)
            reported.setdefault(group, set()).add(element)
    fact = {}
    for key, r in latest.items():
        element, period, unit, _ = key
        clinic, district, region, country = FACILITIES.get(unit, (None,) * 4)
        area = AREA_OF.get(element)
        number = None
        if r["value"] is not None and kinds.get(element) in ("INTEGER_ZERO_OR_POSITIVE", "PERCENTAGE"):
            try:
                number = float(r["value"])
            except ValueError:
                pass
        program = next((p for p in PROGRAMS if p["country"] == country and area == "HIV" and element in p["dataElements"]), None)
        group = (country, area, unit, period)
        seen = len(reported[group]) if country and area and group in reported else None
        wanted = {"Alpha": 3, "Beta": 4}.get(country) if area == "HIV" and seen is not None else None
        updated = datetime.strptime(r["lastUpdated"], "%Y-%m-%dT%H:%M:%S.000").date()
        fact[key] = {
            "data_element_name": names.get(element),
            "program_uid": program and program["id"],
            "health_area": area,
            "facility_name": clinic, "district_name": district, "region_name": region, "country_name": country,
            "year": int(period[:4]), "month": int(period[4:]),
            "quarter": f"{period[:4]}Q{(int(period[4:]) + 2) // 3}",
            "raw_value": r["value"], "numeric_value": number,
            "boolean_value": True if kinds.get(element) == "BOOLEAN" and r["value"] == "true" else None,
            "stored_by": r["storedBy"].lower(),
            "is_explicit_zero": None if r["value"] is None else r["value"] == "0",
            "is_missing_value": r["value"] is None,
            "is_late_reported": (updated - month_end(period)).days > 60,
            "reported_indicator_count": seen, "expected_indicator_count": wanted,
            "completeness_score": seen / wanted if wanted else None,
        }
    return fact
