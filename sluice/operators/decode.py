"""Decode split, dead letters and encode.

``decode`` parses the message body with a declared schema in one JVM-side
``from_json`` (PERMISSIVE, corrupt-record column) and labels every row with a
``dead_reason``: null for good rows, else

* ``empty``        -- null or zero-length body,
* ``undecodable``  -- not UTF-8, not parseable (null struct or corrupt record
  set), or more than one JSON document,
* ``empty_tuple``  -- parsed, but every declared field is null.

``good`` and ``dead_letters`` are filters of the same labelled frame, so
``good + dead = input`` holds by construction.  In a stream both are written
from one ``foreachBatch`` (``sluice.streaming.pipelines.route_stream``).  A
body of any bytes gets a label; none fails the job.

A custom body format plugs in as any Column expression producing a struct
(``decoder=``), or, for binary codecs, as a function over Arrow arrays
(``decode_arrow``); the labelling is the same.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CORRUPT = "_corrupt_record"

# What each protocol's source does with a message it cannot decode.
DEAD_LETTER_DISPOSITION = {
    "amqp": "reject_no_requeue",
    "kafka": "report_and_drop",
    "mqtt": "report_and_drop",
    "jms": "drop",
    "kestrel": "drop",
}


def _json_decoder(schema: T.StructType) -> Callable[[Column], Column]:
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])

    def dec(body: Column) -> Column:
        return F.from_json(body, with_corrupt,
                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return dec


def decode(df: DataFrame, schema: T.StructType, value_col: str = "value",
           decoder: Callable[[Column], Column] | None = None,
           output: str = "decoded") -> DataFrame:
    """Add ``output`` (struct of ``schema``) and ``dead_reason``."""
    body = F.try_validate_utf8(F.col(value_col).cast("string"))
    dec = decoder or _json_decoder(schema)
    raw = F.col(value_col)

    def label(p: Column) -> Column:
        all_null = F.lit(True)
        for f in schema.fields:
            all_null = all_null & p.getField(f.name).isNull()
        # the parser stops at the end of the first document: as the one element of
        # an array, anything after it shows
        single = F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1
        has_corrupt = (p.getField(CORRUPT).isNotNull() | ~F.coalesce(single, F.lit(False))) if decoder is None else F.lit(False)
        reason = (F.when(raw.isNull() | (F.length(raw) == 0), F.lit("empty"))
                  .when(p.isNull() | has_corrupt, F.lit("undecodable"))
                  .when(all_null, F.lit("empty_tuple")))
        decoded = F.struct(*[F.when(reason.isNull() | (reason != "undecodable"), p.getField(f.name)).alias(f.name)
                             for f in schema.fields])
        return F.struct(decoded.alias("v"), reason.alias("r"))

    # The parse is bound once per row (a one-element ``transform`` is a let):
    # a later filter on dead_reason is pushed below this projection, and
    # without the binding every field reference there would re-parse.
    pair = F.element_at(F.transform(F.array(dec(body)), label), 1)
    d = df.select("*", pair.alias("_decode_pair"))
    return d.select(*[F.col(c) for c in df.columns],
                    F.col("_decode_pair.v").alias(output), F.col("_decode_pair.r").alias("dead_reason"))


ArrowDecoder = Callable[[pa.Array], pa.StructArray]


def _contained(decoder: ArrowDecoder, bodies: pa.Array, kind: pa.DataType) -> pa.Array:
    """What the decoder makes of the bodies, null where it fails: an array that it fails on is halved until the
    failure is alone, so k bad bodies of n cost about k log n calls."""
    if not len(bodies):
        return pa.array([], kind)
    try:
        out = decoder(bodies)
        if len(out) != len(bodies):
            raise ValueError("a decoder returns one value a body")
        return out.cast(kind)
    except Exception:
        if len(bodies) == 1:
            return pa.nulls(1, kind)
        half = len(bodies) // 2
        return pa.concat_arrays([_contained(decoder, bodies[:half], kind), _contained(decoder, bodies[half:], kind)])


def decode_arrow(df: DataFrame, schema: T.StructType, decoder: ArrowDecoder, value_col: str = "value",
                 output: str = "decoded") -> DataFrame:
    """U1 for binary bodies: ``decoder`` takes a binary array and returns a struct array of ``schema``, null for what it
    cannot read; an exception costs only the bodies that raise it.  Adds ``output`` and ``dead_reason`` as ``decode`` does.
    Null and empty bodies are never passed to the decoder."""
    kind = pa.struct(list(to_arrow_schema(schema)))
    result = T.StructType([*df.schema.fields, T.StructField(output, schema), T.StructField("dead_reason", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(value_col).cast(pa.binary())
            full = pc.fill_null(pc.greater(pc.binary_length(bodies), 0), False)
            made = _contained(decoder, bodies.filter(full), kind)
            place = pc.if_else(full, pc.subtract(pc.cumulative_sum(full.cast(pa.int64())), 1), None)
            decoded = made.take(place) if len(made) else pa.nulls(len(bodies), kind)
            nothing = pa.array([True] * len(decoded))
            for i in range(len(schema.fields)):
                nothing = pc.and_(nothing, pc.struct_field(decoded, [i]).is_null())
            reason = pc.if_else(pc.invert(full), "empty", pc.if_else(decoded.is_null(), "undecodable", pc.if_else(nothing, "empty_tuple", pa.scalar(None, pa.string()))))
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded, reason.cast(pa.string())], names=[*batch.schema.names, output, "dead_reason"])

    return df.mapInArrow(run, result)


def good(decoded: DataFrame, output: str = "decoded", flatten: bool = True) -> DataFrame:
    """Rows that decoded; with ``flatten`` the decoded fields become columns."""
    g = decoded.where(F.col("dead_reason").isNull()).drop("dead_reason")
    if flatten:
        g = g.select("*", f"{output}.*").drop(output)
    return g


def dead_letters(decoded: DataFrame, output: str = "decoded") -> DataFrame:
    """Undecodable rows with reason, error class and protocol disposition."""
    disp = F.lit(None).cast("string")
    for proto, action in DEAD_LETTER_DISPOSITION.items():
        disp = F.when(F.col("protocol") == proto, F.lit(action)).otherwise(disp)
    return (decoded.where(F.col("dead_reason").isNotNull())
            .drop(output)
            .withColumn("error_class", F.lit("DeserializationError"))
            .withColumn("disposition", disp if "protocol" in decoded.columns else F.lit("drop")))


def encode_json(fields: list[str | Column]) -> Column:
    """Tuple -> message body (JSON bytes)."""
    return F.encode(F.to_json(F.struct(*fields)), "UTF-8")


def observe_counts(decoded: DataFrame, name: str = "decode"):
    """U4 / A5 reporting: attach good / dead counters to the frame with
    ``DataFrame.observe`` (collected as a side effect of whatever action or
    micro-batch runs it; no extra job).  Returns (frame, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    dead = F.col("dead_reason").isNotNull()
    out = decoded.observe(obs, F.count(F.lit(1)).alias("messages"),
                          F.sum(F.when(dead, 1).otherwise(0)).alias("dead"),
                          F.sum(F.when(dead, 0).otherwise(1)).alias("good"))
    return out, obs


# Fixed value: the line separator of the text payloads of the queue example.
PAYLOAD_SEPARATOR = "\r\n"


def timestamp_payload_decoder() -> Callable[[Column], Column]:
    """U1 example for a non-JSON body: ``<epoch ms>CRLF<filler>`` -> struct(sent_ms,
    filler_len).  JVM-side string functions, no Python UDF."""
    def dec(body: Column) -> Column:
        head = F.substring_index(body, PAYLOAD_SEPARATOR, 1)
        ms = head.try_cast("long")
        rest_len = F.length(body) - F.length(head) - F.lit(len(PAYLOAD_SEPARATOR))
        return F.when(body.contains(PAYLOAD_SEPARATOR) & ms.isNotNull(),
                      F.struct(ms.alias("sent_ms"), rest_len.cast("long").alias("filler_len")))
    return dec


TIMESTAMP_PAYLOAD = T.StructType([T.StructField("sent_ms", T.LongType()), T.StructField("filler_len", T.LongType())])


BINARY_PAYLOAD = T.StructType([T.StructField("sent_ms", T.LongType()), T.StructField("body", T.BinaryType())])


def timestamp_body_decoder(bodies: pa.Array) -> pa.StructArray:
    """U1 example for a binary body: ``<epoch ms>CRLF<bytes>`` -> struct(sent_ms, body).  A head that is no number raises,
    as a codec's own error does; a body without the separator is null."""
    at = pc.find_substring(bodies, PAYLOAD_SEPARATOR.encode())
    lines = pc.split_pattern(bodies, PAYLOAD_SEPARATOR.encode(), max_splits=1)
    whole = pc.greater_equal(at, 0)
    head = pc.if_else(whole, pc.list_element(lines, 0), None).cast(pa.string())
    tail = pc.list_element(pc.if_else(whole, lines, pa.scalar([b"", b""], lines.type)), 1)
    return pa.StructArray.from_arrays([head.cast(pa.int64()), tail], names=["sent_ms", "body"], mask=pc.invert(whole))
