"""API envelope files (SRC-1, SRC-2).

An envelope is one API response body::

    {"get": "teams", "parameters": {...}, "errors": [], "results": 2,
     "paging": {...}, "response": [{...}, {...}]}

Only ``errors``, ``results`` and ``response`` matter; ``paging`` is ignored
and every file given is read (Q16). ``response`` elements and ``errors`` are cut
out of the body as the text they were received in: a JSON parser that
re-serialises would turn ``1.10`` into ``1.1`` and round long numbers. One Arrow
function per body finds where each element begins and ends.

Error gate: an envelope is accepted when ``errors`` is absent, ``[]`` or
``{}``, byte for byte; anything else (``null`` and ``[ ]`` too), or a body that is
not JSON, rejects it. An empty ``response`` is accepted and yields no rows;
``results`` is never compared.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import small_batches

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("get", T.StringType()),
    T.StructField("parameters", T.StringType()),
    T.StructField("results", T.IntegerType()),
])
# Fixed values of the reference's gate: the only accepted non-empty error texts.
ACCEPTED_ERROR_TEXTS = ("[]", "{}")
#: Bodies that a Python worker holds at once, each with all its elements, and their bytes (or one body).
BODIES_AT_ONCE, BYTES_AT_ONCE = 64, 4 << 20


def read_envelopes(spark: SparkSession, path, line_delimited: bool = False) -> DataFrame:
    """One row per envelope: ``source_file``, ``block`` (where the split that holds it begins in
    the file), ``line`` (ascending within the split), ``body``, ``body_hash``. File, block and
    line give the order of arrival without a sort.

    By default each file is one response body (pages are small and bounded
    by the API's page size). With ``line_delimited`` every line of a file is
    one body, so many responses can share a file and large files split."""
    df = spark.read.text(path, wholetext=not line_delimited)
    if line_delimited:
        df = df.filter(F.length(F.trim("value")) > 0)
    return df.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"), F.col("value").alias("body"),
                     F.md5("value").alias("body_hash"))


def _refuse(name: str):
    raise ValueError(f"{name} is not JSON")


# numbers stay text, so that none is too long; NaN and Infinity are no JSON
_DECODER = json.JSONDecoder(parse_int=str, parse_float=str, parse_constant=_refuse)
_SPACE = re.compile(r"[ \t\n\r]*")


def _skip(text: str, at: int) -> int:
    return _SPACE.match(text, at).end()


def raw_parts(body: str | None) -> tuple[str | None, list | None]:
    """``errors`` as received (None: absent) and the elements of ``response`` as
    received; elements are None if the body is no JSON object with an array there."""
    try:
        at = _skip(body or "", 0)
        if (body or "")[at:at + 1] != "{":
            return None, None
        errors, response = None, []
        at = _skip(body, at + 1)
        if body[at] == "}":
            return (None, []) if _skip(body, at + 1) == len(body) else (None, None)
        while True:
            key, at = _DECODER.raw_decode(body, at)
            at = _skip(body, at)
            if not isinstance(key, str) or body[at] != ":":
                return None, None
            begin = _skip(body, at + 1)
            if key == "response" and body[begin] == "[":
                response, at = _array(body, begin)
            else:
                _, at = _DECODER.raw_decode(body, begin)
                if key == "errors":
                    errors = body[begin:at]
                elif key == "response":
                    response = [] if body[begin:at] == "null" else None
            at = _skip(body, at)
            if body[at] == "}":
                return (errors, response) if _skip(body, at + 1) == len(body) else (None, None)
            if body[at] != ",":
                return None, None
            at = _skip(body, at + 1)
    except (ValueError, IndexError, RecursionError):
        return None, None


def _array(body: str, at: int) -> tuple[list, int]:
    """The elements of the array at ``at``, each as its own text, and where the array ends."""
    out, at = [], _skip(body, at + 1)
    if body[at] == "]":
        return out, at + 1
    while True:
        _, end = _DECODER.raw_decode(body, at)
        out.append(body[at:end])
        at = _skip(body, end)
        if body[at] == "]":
            return out, at + 1
        if body[at] != ",":
            raise ValueError("an array's elements are set apart by commas")
        at = _skip(body, at + 1)


def parse_envelopes(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Adds the parsed wrapper ``env`` and ``raw`` (errors, response as received)."""
    small_batches(df.sparkSession, BODIES_AT_ONCE, BYTES_AT_ONCE)

    @F.pandas_udf("struct<errors:string,response:array<string>>")
    def raw(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([raw_parts(b) for b in bodies], columns=["errors", "response"])

    return (df.withColumn("env", F.from_json(F.col(body_col), ENVELOPE_SCHEMA, {"mode": "PERMISSIVE"}))
            .withColumn("raw", raw(F.col(body_col))))


def accepted() -> "F.Column":
    """Gate verdict: a JSON object with a ``response`` array, and no errors."""
    errors = F.col("raw.errors")
    return F.col("raw.response").isNotNull() & (errors.isNull() | errors.isin(*ACCEPTED_ERROR_TEXTS))


def gate_errors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split parsed envelopes into (accepted, rejected). The pipeline fails
    the load when ``rejected`` is non-empty, as the reference does."""
    flag = parsed.withColumn("__ok", accepted())
    return (flag.filter(F.col("__ok")).drop("__ok"),
            flag.filter(~F.col("__ok")).drop("__ok"))


def staged(parsed: DataFrame, *more: str) -> DataFrame:
    """What a load keeps of parsed envelopes: where each arrived, the gate's verdict ``ok`` and a row
    for each element of ``response`` (``pos``, ``payload``), so that who reads them back in batches of
    thousands of rows holds as many elements, not as many pages. A rejected or empty envelope has one row
    without element. The columns ``more`` stand in an envelope's first row. To be written once: ``line``
    is that of this evaluation."""
    pages = parsed.select("source_file", "block", "line", accepted().alias("ok"),
                          F.col("env.parameters").alias("source_params"), F.col("raw.response").alias("response"), *more)
    rows = pages.select("source_file", "block", "line", "ok", "source_params", *more,
                        F.posexplode_outer(F.when(F.col("ok"), F.col("response"))).alias("pos", "payload"))
    return rows.withColumns({c: F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col(c)) for c in more})


def explode_response(good: DataFrame, keep: list = ()) -> DataFrame:
    """One row per ``response`` element: ``pos`` and raw ``payload`` text."""
    return good.select(*keep, F.col("env.parameters").alias("source_params"),
                       F.posexplode(F.col("raw.response")).alias("pos", "payload"))
