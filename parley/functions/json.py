"""JSON contracts: analysis struct, endpoint response / error envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import config

ANALYSIS_FIELDS = ("speaker_1", "speaker_2", "main_topics", "conversation_tone",
                   "conversation_summary")

ANALYSIS_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in ANALYSIS_FIELDS])


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_analysis(df: DataFrame, json_col: str = "conversation_analysis",
                   drop_source: bool = True) -> DataFrame:
    """JSON text -> five flat string columns.

    Malformed JSON gives a struct of NULLs, NULL input gives NULL fields;
    non-string scalars are kept as their JSON text.
    """
    keep = [c for c in df.columns if c not in ANALYSIS_FIELDS and not (drop_source and c == json_col)]
    parsed = df.select(*keep, F.from_json(F.col(json_col), ANALYSIS_SCHEMA).alias("_analysis"))
    return parsed.select(*keep, *[F.col(f"_analysis.{f}").alias(f) for f in ANALYSIS_FIELDS])


def field_json_type(parsed: Column, field: str) -> Column:
    """Type name of a top-level field of a parsed VARIANT (``STRING``,
    ``BIGINT``, ``VOID`` for JSON null, ``OBJECT<..>``); NULL when absent."""
    return F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))


def violations_of(parsed: Column) -> Column:
    """Required fields missing, NULL or not strings in a parsed VARIANT
    (NULL variant, i.e. text that is not JSON: every field)."""
    checks = [F.when(F.coalesce(field_json_type(parsed, f) == F.lit("STRING"), F.lit(False)),
                     F.lit(None).cast("string")).otherwise(F.lit(f))
              for f in ANALYSIS_FIELDS]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def with_contract_violations(df: DataFrame, json_col: str, out_col: str = "violations") -> DataFrame:
    """Adds ``out_col``: the strict contract check (all five fields present as
    strings).  ``from_json`` alone is permissive (it stringifies numbers and
    fills NULLs), so the raw text is parsed once as a VARIANT and each
    field's type is checked."""
    parsed = df.withColumn("_variant", F.try_parse_json(F.col(json_col)))
    return parsed.withColumn(out_col, violations_of(F.col("_variant"))).drop("_variant")


def contract_violations(json_col: str | Column) -> Column:
    """Column form of the contract check (parses inside the expression;
    prefer :func:`with_contract_violations` on large inputs)."""
    return violations_of(F.try_parse_json(_col(json_col)))


# One parse of a response body; maps keep a JSON-null field apart from a
# missing one.
RESPONSE_SCHEMA = T.StructType([
    T.StructField(env, T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    for env in config.RESPONSE_ENVELOPES])


def parse_response(body: str | Column) -> Column:
    return F.from_json(_col(body), RESPONSE_SCHEMA)


def _first_record(parsed: Column, env: str) -> Column:
    return F.try_element_at(parsed[env], F.lit(1))


def has_envelope(parsed: Column) -> Column:
    present = [parsed[env].isNotNull() for env in config.RESPONSE_ENVELOPES]
    return F.coalesce(present[0] | present[1], F.lit(False))


def transcription_of(parsed: Column) -> Column:
    """Decode a parsed 200 response (see :func:`response_transcription`)."""
    field = F.lit(config.TRANSCRIPTION_FIELD)

    def from_env(env: str) -> Column:
        first = _first_record(parsed, env)
        return F.when(F.coalesce(F.map_contains_key(first, field), F.lit(False)),
                      F.try_element_at(first, field)).otherwise(F.lit(""))

    first_env, second_env = config.RESPONSE_ENVELOPES
    return (F.when(parsed[first_env].isNotNull(), from_env(first_env))
             .when(parsed[second_env].isNotNull(), from_env(second_env)))


def model_error_of(parsed: Column) -> Column:
    """The model's own ``error`` field of the first record, if any."""
    return F.coalesce(*[F.try_element_at(_first_record(parsed, env), F.lit("error"))
                        for env in config.RESPONSE_ENVELOPES])


def response_transcription(body: str | Column) -> Column:
    """Decode a 200 response.

    ``predictions[0].transcription`` if a ``predictions`` envelope exists,
    else ``dataframe_records[0].transcription``; a present envelope without
    the field gives ``""``; no envelope gives NULL (nothing appended).
    JSON null in the field stays NULL.
    """
    return transcription_of(parse_response(body))


def malformed_response(body: str | Column) -> Column:
    """Why a 200 body cannot be decoded, or NULL.

    A body that is not JSON (NULL included), and an envelope that is not an
    array whose first element is an object, are errors.  JSON without any
    envelope is not one: it decodes to NULL, as :func:`response_transcription`
    says.
    """
    parsed = F.try_parse_json(_col(body))

    def kind(path: str) -> Column:
        return F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))

    def broken(env: str) -> Column:
        return ~F.coalesce(kind(f"$.{env}[0]").startswith("OBJECT"), F.lit(False))
    first, second = config.RESPONSE_ENVELOPES
    bad = F.when(kind(f"$.{first}").isNotNull(), broken(first)).otherwise(
        kind(f"$.{second}").isNotNull() & broken(second))
    return (F.when(parsed.isNull(), F.lit(f"{config.EXCEPTION_PREFIX}response is not JSON"))
             .when(bad, F.lit(f"{config.EXCEPTION_PREFIX}malformed response envelope")))


def endpoint_error(status: str | Column, body: str | Column, whole: bool = False) -> Column:
    """``ENDPOINT_ERROR: {code} - {message[:100]}`` for a non-200 response.

    A JSON object body gives ``error_code`` (default ``UNKNOWN``) and
    ``message`` (default the body's first 200 chars); any other body gives
    ``HTTP_{status}`` and the body's first 200 chars.  ``whole`` cuts nothing.
    """
    s, b = _col(status), _col(body)
    is_obj = F.json_object_keys(b).isNotNull()
    head = F.coalesce(b, F.lit(""))
    if not whole:
        head = F.left(head, F.lit(config.ENDPOINT_BODY_CHARS))
    code = F.when(is_obj, F.coalesce(F.get_json_object(b, f"$.{config.ERROR_CODE_FIELD}"),
                                      F.lit(config.UNKNOWN_ERROR_CODE))) \
            .otherwise(F.concat(F.lit(config.HTTP_CODE_PREFIX), s.cast("string")))
    msg = F.when(is_obj, F.coalesce(F.get_json_object(b, f"$.{config.MESSAGE_FIELD}"), head)) \
           .otherwise(head)
    return F.concat(F.lit(config.ENDPOINT_ERROR_PREFIX), code, F.lit(config.ENDPOINT_ERROR_SEPARATOR),
                    msg if whole else F.left(msg, F.lit(config.ENDPOINT_MESSAGE_CHARS)))
