"""Text expressions: tolerant JSON of model answers, keyword and tag rules, lists, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one known keyword, the word it needs and the phrases of which one must occur beside it.
KEYWORD = "airport_pick_up_drop_off"
KEYWORD_NEEDS = "airport"
KEYWORD_PHRASES = ("pick up", "pick-up", "parking", "drop off", "drop-off")


def comma_list(text: Column) -> Column:
    """The trimmed non-empty parts of a comma-separated text; an empty array for null."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def balanced_block(text: Column) -> Column:
    """The first ``{...}`` whose braces balance; null if there is none."""
    start = F.instr(text, "{")
    rest = F.substr(text, start)
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(s, c):
        depth = s["depth"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)
        at = s["at"] + 1
        return F.struct(depth.alias("depth"), at.alias("at"), F.when((s["end"] == 0) & (c == "}") & (depth == 0), at).otherwise(s["end"]).alias("end"))

    end = F.aggregate(F.split(rest, ""), zero, step)["end"]
    return F.when((start > 0) & (end > 0), F.substr(rest, F.lit(1), end))


def tolerant_map(text: Column) -> Column:
    """The answer's JSON object as a map of strings, or null.

    What comes before the last closing think tag goes, answer tags go, escaped quotes become apostrophes, a comma is put
    between lines that lack one, and the first balanced object is parsed. Spaces in keys become underscores; of equal
    keys the last wins (``spark.sql.mapKeyDedupPolicy`` must be LAST_WIN).
    """
    t = F.regexp_replace(text, r"(?s)^.*</think>", "")
    t = F.regexp_replace(t, r"</?answer>", "")
    t = F.replace(t, F.lit('\\"'), F.lit("'"))
    t = F.replace(t, F.lit("\r\n"), F.lit("\n"))
    t = F.regexp_replace(t, r'"\s*\n\s*"', '",\n"')
    return F.transform_keys(F.from_json(balanced_block(t), "map<string,string>"), lambda k, _: F.replace(k, F.lit(" "), F.lit("_")))


def keyword_in_caption(caption: Column, keyword: str) -> Column:
    """Whether a caption fits the keyword, in any case of letters; unknown keywords and null captions never do."""
    if keyword != KEYWORD:
        return F.lit(False)
    low = F.lower(caption)
    return F.coalesce(low.contains(KEYWORD_NEEDS) & low.rlike("|".join(KEYWORD_PHRASES)), F.lit(False))


# The pattern of the three conditions that a caption names, in order, and the tags that its groups give.
CONDITIONS = "visibility condition(.+)road surface condition(.+)illumination condition(.+)"
CONDITION_TAGS = ("visibility", "road_condition", "illumination")


def condition_tags(caption: Column) -> Column:
    """A struct of the three conditions of a caption, lower-cased without ``*``, ``:`` and trailing dots; null if it lacks any."""
    low = F.translate(F.lower(F.regexp_replace(caption, r"\r\n|[\n\r]", " ")), "*:", "")
    part = lambda i: F.regexp_replace(F.trim(F.regexp_extract(low, CONDITIONS, i)), r"\.+$", "")
    return F.when(low.rlike(CONDITIONS), F.struct(*(part(i + 1).alias(name) for i, name in enumerate(CONDITION_TAGS))))


def events_payload(answer: Column) -> Column:
    """The events of a model answer as an array of JSON texts; empty where nothing can be parsed.

    A code fence goes; what is left is read as a whole, else from its first to its last brace, else bracket. Of an
    object the ``events`` array counts.
    """
    t = F.regexp_replace(F.regexp_replace(F.trim(answer), r"^```(json)?\s*", ""), r"\s*```$", "")
    t = F.regexp_replace(t, r"[\n\t\r]", " ")
    inner = lambda p: F.nullif(F.regexp_extract(t, p, 0), F.lit(""))
    parsed = F.coalesce(F.try_parse_json(t), F.try_parse_json(F.coalesce(inner(r"\{.*\}"), inner(r"\[.*\]"))))
    bare = F.try_variant_get(parsed, "$", "array<variant>")
    of = F.coalesce(F.try_variant_get(parsed, "$.events", "array<variant>"), bare, F.array().cast("array<variant>"))
    return F.transform(of, lambda v: F.to_json(v))


def event_prompt(template: str, instances: Column, seconds: Column) -> Column:
    """The template with ``{instances}`` as JSON and ``{duration}`` to a tenth of a second."""
    return F.replace(F.replace(F.lit(template), F.lit("{instances}"), F.coalesce(F.to_json(instances), F.lit("[]"))), F.lit("{duration}"), F.format_string("%.1f", seconds.cast("double")))


def first_present(captions: Column, fields: list[str]) -> Column:
    """The value of the first of the fields that a caption map has."""
    return F.coalesce(*(captions[f] for f in fields))


def all_captions(windows: Column) -> Column:
    """Captions of all windows, each a map, in window order."""
    return F.flatten(F.transform(windows, lambda w: F.map_values(w)))


def parent_folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def relative_path(path: Column, prefix: str) -> Column:
    """The path below a prefix, with or without its slash; unchanged if it lies elsewhere."""
    p = prefix.rstrip("/") + "/"
    return F.when(F.startswith(path, F.lit(p)), F.substr(path, F.lit(len(p) + 1))).otherwise(path)


def has_extension(path: Column, *extensions: str) -> Column:
    return F.lower(path).rlike(rf"\.({'|'.join(extensions)})$")


def is_uuid(text: Column) -> Column:
    return F.coalesce(F.lower(text).rlike("^[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}$"), F.lit(False))


def caption_status(finish: Column, text: Column) -> Column:
    """success, truncated, blocked or error, from a provider's finish reason and the text it gave."""
    empty = text.isNull() | (F.trim(text) == "")
    return F.when(finish == "content_filter", "blocked").when(empty, "error").when(finish == "length", "truncated").otherwise("success")


def with_error(errors: Column, key: str, message: Column) -> Column:
    """An error map with one more entry where the message is not null."""
    base = F.coalesce(errors, F.create_map().cast("map<string,string>"))
    return F.when(message.isNull(), base).otherwise(F.map_concat(F.map_filter(base, lambda k, _: k != key), F.create_map(F.lit(key), message)))


def upper(text: str) -> str:
    """Upper case one character for one, as SQL has it: sharp s is a capital sharp s, ligatures stay."""
    made = text.upper()
    if len(made) == len(text):  # a case mapping never drops a character
        return made
    return "".join(u if len(u := c.upper()) == 1 else t if len(t := c.title()) == 1 else "\u1e9e" if c == "\u00df" else c for c in text)
