"""Column builders for tags, messages, names and small text formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tag patterns in the order in which they are tried, over stripped upper-case text of 2 to 20 characters.
TAG_RULES: list[tuple[str, str]] = [
    (r"""^\d{1,2}\.?\d?["'-]?[A-Z]{2,4}[-]?\d{2,4}""", "line_number"),
    (r"^[AFHLPSTQVW][A-Z]{1,3}-?\d{2,5}$", "instrument_tag"),
    (r"^[AFHLPT]V-?\d{2,4}$", "valve_tag"),
    (r"^[BHM]?V-?\d{2,4}[A-Z]?$", "valve_tag"),
    (r"^[A-Z]{1,2}-\d{2,4}[A-Z]?$", "equipment_tag"),
    (r"^(TK|HX|RX|CV|FD)-?\d{2,4}[A-Z]?$", "equipment_tag"),
    (r"^\d+\.?\d*\s*(PSI|PSIG|PSIA|BAR|BARG|°?[CF]|MM|IN|GPM|LPM|M3/H)", "measurement"),
    (r"^\d+\.?\d*\s*%$", "measurement"),
]

#: Relationship types of elements, by lower-case element name.
RELATIONSHIP_TYPES = {
    "sldid": "slide",
    "sldmasterid": "slidemaster",
    "notesmasterid": "notesmaster",
    "sldlayoutid": "slidelayout",
    "themeid": "theme",
    "tablestyleid": "tablestyles",
}

#: Fixed value: the shape of an identifier of five parts, with the letters that may stand in it.
UUID_SHAPE = r"^\{{?[0-9{0}]{{8}}-?[0-9{0}]{{4}}-?[0-9{0}]{{4}}-?[0-9{0}]{{4}}-?[0-9{0}]{{12}}\}}?$"

#: Parts of metric names that tell whether more or less is better; others are better when higher.
RISING, FALLING = ("rate", "coverage"), ("unresolved", "orphan", "warning", "unvalidated")

#: Allowed front-matter keys.
FRONT_MATTER_KEYS = ["name", "description", "license", "allowed-tools", "metadata"]


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def classify_tag(text: Column, rules: Sequence[tuple[str, str]] = TAG_RULES) -> Column:
    """The class of the first rule that matches; rules are data, so callers may extend the list."""
    t = F.upper(strip(text))
    out = F.when(t.isNull() | ~F.length(t).between(2, 20), F.lit("label"))
    for pattern, name in rules:
        out = out.when(t.rlike(pattern), F.lit(name))
    return out.otherwise(F.lit("label"))


def same_place_share(a: Column, b: Column) -> Column:
    """Share of places at which two texts hold the same character, of the longer one's length."""
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda e: e))
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most > 0, same.cast("double") / most).otherwise(F.lit(0.0))


def either_contains(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


def last_capture(text: Column, tag: str) -> Column:
    """What stands in the last <tag>...</tag>, stripped; null without one."""
    return strip(F.try_element_at(F.regexp_extract_all(text, F.lit(f"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1)), F.lit(-1)))


def parse_pairs(entries: Column, separator: str) -> Column:
    """A map from `key<separator>value` entries, cut once; entries without the separator are left out, later keys win."""
    good = F.filter(entries, lambda e: e.contains(separator))
    pairs = F.transform(good, lambda e: F.struct(strip(F.substring_index(e, separator, 1)).alias("key"), strip(F.substring(e, F.instr(e, separator) + len(separator), 1 << 30)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + F.lit(2), F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def exact_score(actual: Column, expected: Column) -> Column:
    """1 for equal texts that are there, else 0."""
    return F.when((F.length(actual) > 0) & (actual == expected), 1).otherwise(0)


def generated_id(prefix: str, n: Column) -> Column:
    return F.format_string(f"{prefix}-%03d", n.cast("int"))


def iso_now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")


def compact_stamp(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd_HHmmss")


def strip_templates(text: Column) -> Column:
    return F.regexp_replace(text, r"\{\{[^}]*\}\}", "")


def local_name(tag: Column) -> Column:
    return F.lower(F.element_at(F.split(tag, r"\}"), -1))


def relationship_type(element: Column) -> Column:
    """The relationship type that an element's reference needs: from the table, else from its name's ending."""
    name = F.lower(element)
    out = None
    for key, kind in RELATIONSHIP_TYPES.items():
        out = (F if out is None else out).when(name == key, F.lit(kind))
    stem = F.regexp_extract(name, r"^(.+)id$", 1)
    out = out.when(stem == "sld", F.lit("slide")).when(stem != "", stem)
    return out.when(name.rlike("^.+reference$"), F.regexp_extract(name, "^(.+)reference$", 1))


def schema_file(part: Column) -> Column:
    """Which schema family judges a part, by its name and folder."""
    return (
        F.when(part.endswith(".rels"), F.lit("relationships"))
        .when(part.endswith("[Content_Types].xml"), F.lit("content-types"))
        .when(part.rlike(r"(^|/)docProps/"), F.lit("properties"))
        .when(part.rlike(r"(^|/)(charts|chart)/"), F.lit("chart"))
        .when(part.rlike(r"(^|/)theme/"), F.lit("drawing"))
        .when(part.rlike(r"^word/"), F.lit("wordprocessing"))
        .when(part.rlike(r"^ppt/"), F.lit("presentation"))
        .when(part.rlike(r"^xl/"), F.lit("spreadsheet"))
    )


def resolve_target(folder: Column, target: Column) -> Column:
    """A relationship target as a path from the package root: absolute, or relative to the owner's folder with '..' resolved."""
    parts = F.split(F.when(target.startswith("/"), F.substring(target, 2, 1 << 30)).otherwise(F.concat_ws("/", F.nullif(folder, F.lit("")), target)), "/")
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when((p == ".") | (p == ""), acc).otherwise(F.concat(acc, F.array(p))))
    return F.array_join(walked, "/")


def title_case(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("-"), F.lit(" ")))


def uuid_shaped(text: Column) -> Column:
    return text.rlike(UUID_SHAPE.format("A-Za-z"))


def uuid_valid(text: Column) -> Column:
    return text.rlike(UUID_SHAPE.format("A-Fa-f"))


def front_matter(text: Column) -> Column:
    """The YAML block at the head of a text, null without one."""
    return F.nullif(F.regexp_extract(text, r"(?s)^---\n(.*?)\n---", 1), F.lit(""))


def skill_verdict(keys: Column, name: Column, description: Column) -> Column:
    """Which front-matter rule a skill breaks first, or 'valid'."""
    name, description = strip(name), strip(description)
    return (
        F.when(F.size(F.array_except(keys, F.array(*map(F.lit, FRONT_MATTER_KEYS)))) > 0, "unexpected_key")
        .when(~F.array_contains(keys, "name"), "missing_name")
        .when(~F.array_contains(keys, "description"), "missing_description")
        .when((name != "") & ~name.rlike("^[a-z0-9-]+$"), "name_case")
        .when(name.startswith("-") | name.endswith("-") | name.contains("--"), "name_hyphens")
        .when(F.length(name) > 64, "name_length")
        .when(description.contains("<") | description.contains(">"), "description_brackets")
        .when(F.length(description) > 1024, "description_length")
        .otherwise("valid")
    )


def manual_bullet(paragraphs: Column) -> Column:
    return F.exists(paragraphs, lambda p: p.rlike("^[•●○] "))


def greedy_wrap(text: Column, width: int, char_width: float = 1.0) -> Column:
    """Lines of at most `width` units, words kept whole, by a fixed width for each character."""
    most = int(width / char_width)
    return F.aggregate(
        F.filter(F.split(text, " "), lambda w: w != ""),
        F.array().cast("array<string>"),
        lambda acc, w: F.when((F.size(acc) > 0) & (F.length(F.element_at(acc, -1)) + 1 + F.length(w) <= most), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.concat_ws(" ", F.element_at(acc, -1), w)))).otherwise(F.concat(acc, F.array(w))),
    )


def metric_gain(metric: Column, before: Column, after: Column) -> Column:
    """after - before, turned round for metrics that are better when lower."""
    named = lambda parts: metric.rlike("|".join(parts))
    return F.when(named(FALLING) & ~named(RISING), before - after).otherwise(after - before)
