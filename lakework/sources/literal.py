"""Records stored as the text of a Python literal, e.g. ``{'fiat': True, 'note': None}``.

Almost all of it is JSON with single quotes; what differs is rewritten in JVM
expressions. Only rows that still do not parse go through ``ast.literal_eval``,
which accepts literals and runs no code.
"""

from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lakework.functions.columns import quoted

# A quoted string, a run of text outside quotes, or an unpaired quote. Possessive,
# so that matching neither backtracks nor recurses on long strings.
_TOKEN = r"""(?s)'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+"|[^'"]++|['"]"""
_HEX_ESCAPE = r"(?s)\G((?:[^\\]++|\\[^x])*+)\\x([0-9a-fA-F]{2})"
# Anything up to an escape that JSON lacks or reads differently.
_OTHER_ESCAPE = r"""(?s)^(?:[^\\]++|\\(?:[\\'"nrtbfu]|x[0-9a-fA-F]{2}))*+\\"""
_WORDS = {"True": "true", "False": "false", "None": "null"}
_BAD = "_bad_record"
_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BAD,
    "allowSingleQuotes": "true",
    "allowBackslashEscapingAnyCharacter": "true",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def literal_to_json(text):
    """Literal text to text that Spark's JSON parser accepts; strings keep their content.

    NULL where that takes more than a rewrite: unpaired quotes, rare escapes.
    """
    text = F.col(text) if isinstance(text, str) else text

    def rewrite(token):
        bare = token
        for word, json_word in _WORDS.items():
            bare = F.replace(bare, F.lit(word), F.lit(json_word))
        unescaped = F.regexp_replace(token, _HEX_ESCAPE, r"$1\\u00$2")
        quoted = token.startswith("'") | token.startswith('"')
        return F.when(~quoted, bare).when(token.contains("\\x"), unescaped).otherwise(token)

    def joined(tokens):
        unpaired = F.array_contains(tokens, "'") | F.array_contains(tokens, '"')
        return F.when(~unpaired, F.array_join(F.transform(tokens, rewrite), ""))

    # A list of one, so that the tokens have a name and are found only once.
    tokens = F.array(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)))
    rewritten = F.element_at(F.transform(tokens, joined), 1)
    differs = reduce(or_, [text.contains(part) for part in (*_WORDS, "\\x")])
    other = text.contains("\\") & text.rlike(_OTHER_ESCAPE)
    return F.when(~other & differs, rewritten).when(~other, text)


def _evaluate_udf():
    # Defined here and not at module level, so that it travels to executors by value.
    def evaluate(texts: pd.Series) -> pd.Series:
        import ast
        import json

        def convert(text):
            if text is None:
                return None
            try:
                return json.dumps(ast.literal_eval(text))
            except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
                return None

        return texts.map(convert).astype(object)

    # Said to be nondeterministic so that a later filter, e.g. on the failed flag, is
    # not pushed below and all the parsing repeated in its condition.
    return F.pandas_udf(evaluate, "string").asNondeterministic()


def decode_literals(df, column, schema, into="record", failed="decode_failed"):
    """Parse literal text into a struct column and flag the rows that cannot be read.

    No row is dropped: one that does not fit keeps its text and ``failed`` = true. Its
    struct holds the fields that do fit, and is NULL where there are none.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    lenient = StructType([*schema.fields]).add(_BAD, StringType())

    def parsed(text):
        return F.from_json(text, lenient, _JSON_OPTIONS)

    def readable(struct):
        return F.col(struct).isNotNull() & F.col(struct).getField(_BAD).isNull()

    text = F.col(column)
    first = df.withColumn("_first", parsed(literal_to_json(text)))
    second = first.withColumn(
        "_retry", _evaluate_udf()(F.when(~readable("_first"), text))
    ).withColumn("_second", parsed(F.col("_retry")))
    def partly(struct):
        fields = [F.col(struct).getField(name).isNotNull() for name in schema.names]
        return F.when(reduce(or_, fields), F.col(struct).dropFields(_BAD))

    record = F.when(readable("_first"), F.col("_first").dropFields(_BAD)).when(
        readable("_second"), F.col("_second").dropFields(_BAD)
    ).otherwise(F.coalesce(partly("_second"), partly("_first")))
    unread = text.isNotNull() & ~readable("_first") & ~readable("_second")
    return second.select(
        *[F.col(quoted(c)) for c in df.columns], record.alias(into), unread.alias(failed)
    )


def read_literals(spark, path, schema, glob="*.json", whole_files=True):
    """Literal documents below ``path``, one per file or one per line.

    Adds ``file_path`` and ``datetime``, the file's modification time.
    """
    text = (
        spark.read.text(path, wholetext=whole_files, pathGlobFilter=glob)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("datetime"),
        )
    )
    return decode_literals(text, "value", schema)
