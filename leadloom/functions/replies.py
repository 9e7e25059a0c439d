"""Verdicts out of free reply texts that should hold one JSON object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadloom.functions.text import bound, filled, strip_space
from leadloom.texts import NO_RATIONALE, NO_REASON

FIT_WORDS = ("fit", "yes", "true")
YES_WORDS = ("yes", "true")
CONFIDENCES = ("high", "medium", "low")


def reply_object(reply: Column) -> Column:
    """The reply as a VARIANT object: code fences removed, then the whole text, else the span from
    the first brace to the last. Null when that is no JSON object. Texts that cannot start a JSON
    value are not given to the parser as a whole."""
    def parsed(plain: Column) -> Column:
        whole = F.when(plain.rlike(r'^[\[{"0-9tfnNI-]'), F.try_parse_json(plain))
        span = filled(F.regexp_extract(plain, r"(?s)\{.*\}", 0))
        return bound(
            F.coalesce(whole, F.try_parse_json(span)),
            lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v),
        )

    fenced = strip_space(reply)
    plain = F.when(fenced.contains("```"), strip_space(F.regexp_replace(fenced, r"(?md)^```(?:json)?|```$", ""))).otherwise(fenced)
    return bound(plain, parsed)


def _text(obj: Column, name: str) -> Column:
    """Text of a field: SQL null when absent, ``None`` for a JSON null."""
    value = F.try_variant_get(obj, f"$.{name}", "variant")
    return bound(value, lambda v: F.when(F.is_variant_null(v), F.lit("None")).otherwise(F.try_variant_get(v, "$", "string")))


def _word(obj: Column, name: str) -> Column:
    return F.lower(strip_space(_text(obj, name)))


def _score(value: Column) -> Column:
    """Whole number clamped to 0..100. Fractional numbers are cut; texts must be whole numbers."""
    def whole(v: Column) -> Column:
        kind, text = v["kind"], v["text"]
        return F.when(kind == "STRING", F.regexp_extract(text, r"^\s*([+-]?[0-9]+)\s*$", 1)).when(
            kind == "BOOLEAN", F.when(text == "true", F.lit("1")).otherwise(F.lit("0"))
        ).otherwise(text).try_cast("double")

    facts = F.struct(F.schema_of_variant(value).alias("kind"), F.try_variant_get(value, "$", "string").alias("text"))
    clamp = lambda n: F.when(n < 0, F.lit(0)).when(n > 100, F.lit(100)).otherwise(n.try_cast("int"))
    return bound(bound(facts, whole), clamp)


def fit_reply(reply: Column) -> Column:
    """Struct of the fit verdict in a reply; ``ok`` is false when the reply holds no JSON object."""
    def fields(obj: Column) -> Column:
        return F.struct(
            obj.isNotNull().alias("ok"), _word(obj, "decision").alias("decision"),
            filled(strip_space(_text(obj, "rationale"))).alias("rationale"), filled(_word(obj, "confidence")).alias("confidence"),
            _score(F.try_variant_get(obj, "$.fit_score", "variant")).alias("fit_score"), _word(obj, "domain").alias("domain"),
            F.try_variant_get(obj, "$.domain", "string").alias("given_domain"),
        )

    def verdict(f: Column) -> Column:
        odd = f["confidence"].isNotNull() & ~f["confidence"].isin(*CONFIDENCES)
        absent = F.coalesce(f["given_domain"].isin("false", "0", ""), F.lit(True))
        return F.struct(
            f["ok"].alias("ok"),
            F.when(f["decision"].isin(*FIT_WORDS), "fit").otherwise("not_fit").alias("decision"),
            F.coalesce(f["rationale"], F.lit(NO_RATIONALE)).alias("rationale"),
            F.when(odd, "medium").otherwise(F.coalesce(f["confidence"], F.lit("medium"))).alias("confidence"),
            f["fit_score"].alias("fit_score"),
            F.when(~absent, filled(f["domain"])).alias("domain"),
            odd.alias("odd_confidence"),
        )

    return bound(bound(reply_object(reply), fields), verdict)


def person_reply(reply: Column) -> Column:
    """Struct of the person verdict in a reply."""
    def verdict(obj: Column) -> Column:
        return F.struct(
            obj.isNotNull().alias("ok"),
            F.when(_word(obj, "decision").isin(*YES_WORDS), "yes").otherwise("no").alias("decision"),
            F.coalesce(filled(strip_space(_text(obj, "reason"))), F.lit(NO_REASON)).alias("reason"),
        )

    return bound(reply_object(reply), verdict)


def latest_replies(replies: DataFrame, *keys: str) -> DataFrame:
    """One ``reply`` per key: the one with the latest ``replied_at`` where replies carry it, and of those with
    equal or no times the last in the order of texts. Null replies count only where there is no other."""
    order = F.struct("replied_at", "reply") if "replied_at" in replies.columns else F.struct("reply")
    given = F.when(F.col("reply").isNotNull(), order)
    return replies.groupBy(*keys).agg(F.max_by("reply", given).alias("reply"))
