"""JSON texts of schemas, declarations and prompts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: A JSON text's tokens: strings, single marks, and literals such as numbers.
TOKEN = r'("(?:[^"\\]|\\.)*"|[\[\]{},:]|[^\s\[\]{},:"]+)'
# Fixed values of the prompt's format.
QUOTE = "<escape>"
DECLARED, DECLARED_END = "<start_function_declaration>declaration:", "<end_function_declaration>"


def json_string(value: Column) -> Column:
    """The value as a JSON string with its quotes; other letters than ASCII stay."""
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def render_schema(text: Column) -> Column:
    """A JSON text in a prompt's syntax: bare keys, strings in upper case between marks, null as a marked word, numbers
    and booleans as they are, no white space. Null and malformed texts give null; an object that
    repeats a key counts as malformed.

    Each token is written by itself; a string is a key just where a colon follows. The tokens are bound to a name once, as
    they would be cut anew for each token otherwise, and only strings with escapes are parsed.
    """

    def written(tokens: Column, token: Column, k: Column) -> Column:
        parsed = F.get_json_object(F.concat(F.lit("["), token, F.lit("]")), "$[0]")
        plain = F.when(F.contains(token, F.lit("\\")), parsed).otherwise(F.substring(token, F.lit(2), F.length(token) - 2))
        real = token.rlike("[.eE]") & token.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$")
        return (
            F.when(~F.startswith(token, F.lit('"')), F.when(token == "null", f"{QUOTE}NULL{QUOTE}").when(real, token.cast("double").cast("string")).otherwise(token))
            .when(F.coalesce(F.get(tokens, k + 1) == ":", F.lit(False)), plain)
            .otherwise(F.concat(F.lit(QUOTE), F.upper(plain), F.lit(QUOTE)))
        )

    once = F.array(F.regexp_extract_all(text, F.lit(TOKEN), 1))
    rendered = F.transform(once, lambda tokens: F.array_join(F.transform(tokens, lambda token, k: written(tokens, token, k)), ""))
    return F.when(F.try_parse_json(text).isNotNull(), rendered[0])


@F.pandas_udf(StringType())
def canonical_json(text: pd.Series) -> pd.Series:
    """Keys sorted at all depths, ', ' and ': ' between parts, no escapes for letters; null for null and malformed texts.

    No expression writes numbers as they are read and sorts keys at all depths, so that this runs in
    Python, by Arrow batches.
    """

    written = json.JSONEncoder(sort_keys=True, ensure_ascii=False).encode

    def one(t: str | None) -> str | None:
        try:
            return None if t is None else written(json.loads(t))
        except ValueError:
            return None

    return text.map(one)


def declaration(name: Column, description: Column, schema: Column) -> Column:
    """One tool as a prompt declares it; null where a part is null or the schema malformed."""
    return F.concat(F.lit(DECLARED), name, F.lit(f"{{description:{QUOTE}"), description, F.lit(f"{QUOTE},parameters:"), render_schema(schema), F.lit(f"}}{DECLARED_END}"))


def declarations(skills: DataFrame, order: str = "ord") -> DataFrame:
    """One row (declarations, tools): all skills (alias, description, parameters) declared in order, and how many; a catalogue is small."""
    one = F.struct(F.col(order).alias("at"), declaration(F.col("alias"), F.col("description"), F.col("parameters")).alias("text"))
    listed = F.array_sort(F.collect_list(one))
    return skills.agg(F.array_join(F.transform(listed, lambda x: x["text"]), "").alias("declarations"), F.count(F.lit(1)).alias("tools"))


def prompt(user: Column, declared: Column, developer: str) -> Column:
    """The turns of a prompt: the developer's text with the declarations, the user's, and the model's opened."""
    return F.concat(F.lit(f"<start_of_turn>developer\n{developer}"), declared, F.lit("<end_of_turn>\n<start_of_turn>user\n"), user, F.lit("<end_of_turn>\n<start_of_turn>model\n"))
