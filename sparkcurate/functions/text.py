"""Text functions on columns; all run inside the JVM unless they say otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A slot's name in a frame, in braces.
PLACEHOLDER = r"\{([A-Z][A-Z0-9_]*)\}"
#: Java's \w knows ASCII only, so letters, digits and underscore are spelt out; (?U) gives Unicode spaces.
NOT_WORD = r"[^\p{L}\p{N}_\s]"
SPACES = r"(?U)\s+"
#: What parts words; apostrophes and spaces are among it.
NOT_LETTERS = r"[^\p{L}\p{N}_]+"


def loose_key(text: Column) -> Column:
    """Key of near-equal texts: lower case, punctuation as spaces, single spaces, none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), NOT_WORD, " "), SPACES, " "))


def hygiene(text: Column) -> Column:
    """Single spaces between words, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def elide(text: Column) -> Column:
    """Apostrophes as spaces, so that an elided article parts from its noun."""
    return F.translate(text, "'’", "  ")


def all_words(text: Column) -> Column:
    """Words of the lower-cased text in their order, with elisions split."""
    return F.filter(F.split(F.lower(text), NOT_LETTERS), lambda w: w != "")


def words(text: Column) -> Column:
    """Distinct words of the lower-cased text with elisions split."""
    return F.array_distinct(all_words(text))


def placeholders(text: Column, args: Column | None = None) -> Column:
    """Slots' names in order of their first place: the text's, then those in the arguments' values."""
    found = F.regexp_extract_all(text, F.lit(PLACEHOLDER), 1)
    if args is not None:
        inside = F.transform(F.map_values(args), lambda v: F.regexp_extract_all(v, F.lit(PLACEHOLDER), 1))
        found = F.concat(found, F.coalesce(F.flatten(inside), F.array().cast("array<string>")))
    return F.array_distinct(found)


def substitute(text: Column, values: Column) -> Column:
    """text with each placeholder that values (a map) has replaced, in one pass: braces within values stay as they are."""
    mark = "\x00"
    parts = F.split(F.regexp_replace(text, PLACEHOLDER, f"{mark}$0{mark}"), mark)

    def one(part: Column) -> Column:
        name = F.regexp_extract(part, f"^{PLACEHOLDER}$", 1)
        return F.when(name != "", F.coalesce(F.try_element_at(values, name), part)).otherwise(part)

    return F.array_join(F.transform(parts, one), "")


def fill(template: Column, value: Column) -> Column:
    return F.replace(template, F.lit("{}"), value)


# English contractions that the normaliser writes out.
CONTRACTIONS = {
    "what's": "what is", "it's": "it is", "that's": "that is", "there's": "there is", "where's": "where is", "who's": "who is", "how's": "how is", "let's": "let us",
    "i'm": "i am", "you're": "you are", "we're": "we are", "they're": "they are", "i've": "i have", "you've": "you have", "we've": "we have", "they've": "they have",
    "i'll": "i will", "you'll": "you will", "we'll": "we will", "they'll": "they will", "can't": "can not", "won't": "will not", "don't": "do not", "doesn't": "does not",
    "didn't": "did not", "isn't": "is not", "aren't": "are not", "wasn't": "was not", "weren't": "were not", "couldn't": "could not", "shouldn't": "should not", "wouldn't": "would not",
}
UNITS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()


def expand_contractions(text: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in CONTRACTIONS.items() for x in pair))
    return F.array_join(F.transform(F.split(F.translate(F.lower(text), "’", "'"), SPACES), lambda w: _contracted(w, table)), " ")


def _contracted(word: Column, table: Column) -> Column:
    core = F.regexp_extract(word, r"^([\p{L}']*)", 1)
    return F.concat(F.coalesce(F.try_element_at(table, core), core), F.substring(word, F.length(core) + 1, F.length(word)))


def number_words(text: Column) -> Column:
    """Runs of English number words, up to hundreds of thousands, as digits; the text must be normalised.

    Words are folded from the left with (text so far, thousands, the part below, whether a number is open).
    """
    value = F.create_map(*(F.lit(x) for k, w in enumerate(UNITS) for x in (w, k)), *(F.lit(x) for k, w in enumerate(TENS) for x in (w, 20 + 10 * k)))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"), F.lit(False).alias("open"))

    def done(s: Column) -> Column:
        return F.when(s["open"], F.concat(s["out"], F.lit(" "), (s["high"] + s["low"]).cast("string"))).otherwise(s["out"])

    def state(out: Column, high: Column, low: Column, open_: Column) -> Column:
        return F.struct(out.alias("out"), high.cast("long").alias("high"), low.cast("long").alias("low"), open_.alias("open"))

    def step(s: Column, w: Column) -> Column:
        v = F.try_element_at(value, w)
        tail = s["low"] % 100
        joins = s["open"] & (((tail == 0) & ((s["low"] > 0) | (s["high"] > 0))) | ((v < 10) & (v > 0) & (tail >= 20) & (tail % 10 == 0)))
        zero, yes = F.lit(0).cast("long"), F.lit(True)
        return (
            F.when(v.isNotNull() & joins, state(s["out"], s["high"], s["low"] + v, yes))
            .when(v.isNotNull(), state(done(s), zero, v.cast("long"), yes))
            .when((w == "hundred") & s["open"] & s["low"].between(1, 9), state(s["out"], s["high"], s["low"] * 100, yes))
            .when((w == "thousand") & s["open"] & (s["high"] == 0) & s["low"].between(1, 999), state(s["out"], s["low"] * 1000, zero, yes))
            .otherwise(state(F.concat(done(s), F.lit(" "), w), zero, zero, F.lit(False)))
        )

    folded = F.aggregate(F.split(text, " "), start, step, done)
    return F.when(text == "", "").otherwise(F.substring(folded, 2, F.length(folded)))


def normalize(text: Column, locale: str = "en") -> Column:
    """Lower case without punctuation; in English contractions written out and number words as digits. Twice is as once."""
    base = loose_key(F.regexp_replace(F.translate(text, "’", "'"), "'(?=[^\\p{L}]|$)|(?<![\\p{L}])'", " ")) if locale != "en" else None
    if locale == "en":
        return number_words(loose_key(F.translate(expand_contractions(text), "'", "")))
    return base


def has_digit(text: Column) -> Column:
    return text.rlike("[\\p{Nd}²³¹⁰-⁹₀-₉]")


def trigger_offender(text: Column, triggers: list[str], parts: list[str]) -> Column:
    """Whether a trigger is one of the text's words, or a part stands anywhere in it, or it has a digit."""
    return F.arrays_overlap(words(text), F.array(*map(F.lit, triggers))) | F.lower(text).rlike("|".join(parts)) | has_digit(text)


def keyword_hit(text: Column, all_of: list[list[str]] = (), anywhere: list[str] = (), patterns: list[str] = ()) -> Column:
    """Whether all words of one of the bags are present, or a string stands anywhere, or a pattern matches whole words."""
    own = words(text)
    hit = F.lit(False)
    for bag in all_of:
        hit = hit | (F.size(F.array_except(F.array(*map(F.lit, bag)), own)) == 0)
    for part in anywhere:
        hit = hit | F.contains(F.lower(text), F.lit(part))
    for pattern in patterns:
        hit = hit | F.lower(text).rlike(rf"(?U)\b(?:{pattern})\b")
    return hit


def unanchored(text: Column, mention: str, domain: str) -> Column:
    """A mention, such as of a number or a slot, without any of the domain's words."""
    return text.rlike(mention) & ~F.lower(text).rlike(domain)


def last_segment(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def csv_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def key_value(text: Column) -> Column:
    """(name, value) of NAME=VALUE, split at the first sign; without one the name is null."""
    return F.struct(F.when(F.contains(text, F.lit("=")), F.substring_index(text, "=", 1)).alias("name"), F.element_at(F.split(text, "=", 2), -1).alias("value"))


def strip_fences(text: Column) -> Column:
    """Text without a code fence around it."""
    return F.regexp_replace(F.trim(text), r"^```[A-Za-z]*\s*|\s*```$", "")


def unquote(text: Column) -> Column:
    return F.btrim(text, F.lit('"'))


def percent(share: Column) -> Column:
    """Whole percent, halves to even."""
    return F.format_string("%.0f%%", F.bround(F.lit(100.0) * share))


def declares_id(text: Column, name: str) -> Column:
    import re

    return text.rlike(rf"(?m)^\s*id:\s*{re.escape(name)}\s*$")


def first_call(raw: Column, pattern: str = r"<start_function_call>call:(\w+)\{") -> Column:
    """Name of the first call in a model's output, or null."""
    return F.nullif(F.regexp_extract(raw, pattern, 1), F.lit(""))


def article_di(name: Column, article: Column) -> Column:
    """Italian 'di' with a name's article: la, il or l'."""
    return F.when(article == "la", F.concat(F.lit("della "), name)).when(article == "il", F.concat(F.lit("del "), name)).when(article == "l'", F.concat(F.lit("dell'"), name)).otherwise(F.concat(F.lit("di "), name))


def article_the(name: Column, article: Column) -> Column:
    return F.when(F.coalesce(article, F.lit("")) == "", name).when(F.endswith(article, F.lit("'")), F.concat(article, name)).otherwise(F.concat_ws(" ", article, name))


def version_name(released: Column, sha: Column) -> Column:
    return F.concat(F.date_format(released, "yyyy.MM.dd"), F.lit("-"), F.left(sha, F.lit(7)))


def iso_utc(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def backoff(tries: Column) -> Column:
    """Seconds to wait after so many failures."""
    return F.least(F.lit(5) * F.pow(F.lit(2), tries), F.lit(60)).cast("int")
