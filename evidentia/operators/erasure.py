"""Erasure: a subject's own entities leave archived pages, references to it are scrubbed, and the observation's id and
provenance stay, with the erasure run that changed the page. Suppressed subjects are kept as keyed tokens."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Members that say whose an entity is.
OWNERS = ("author", "user", "member")


def owned(entity, subject: str) -> bool:
    """Whether a JSON object is the subject or belongs to it."""
    if not isinstance(entity, dict):
        return entity == subject
    if entity.get("id") == subject or entity.get("user_id") == subject:
        return True
    return any(isinstance(entity.get(k), dict) and (entity[k].get("id") == subject or isinstance(entity[k].get("user"), dict) and entity[k]["user"].get("id") == subject) for k in OWNERS)


def scrubbed(node, subject: str, mention: re.Pattern):
    """A JSON value without the subject: owned entities leave arrays and become null elsewhere, mentions in texts
    lose the id, members named by it go. All other members stay as they are, known or not."""
    if isinstance(node, list):
        return [scrubbed(x, subject, mention) for x in node if not owned(x, subject)]
    if isinstance(node, dict):
        return {k: None if owned(v, subject) else scrubbed(v, subject, mention) for k, v in node.items() if k != subject}
    return mention.sub("erased", node) if isinstance(node, str) else node


def scrub(payload: Column, subject: str) -> Column:
    """A page's JSON text without the subject; pages without its id aren't parsed and stay byte by byte."""
    mention = re.compile(rf"(?<![0-9]){re.escape(subject)}(?![0-9])")

    @F.pandas_udf("string")
    def each(pages: pd.Series) -> pd.Series:
        return pages.map(lambda t: None if t is None else json.dumps(scrubbed(json.loads(t), subject, mention), ensure_ascii=False, separators=(",", ":")))

    hit = payload.rlike(rf"(?<![0-9]){subject}(?![0-9])")
    return F.coalesce(each(F.when(hit, payload)), payload)


def erase(envelopes: DataFrame, subject: str, run_id: str | None = None) -> DataFrame:
    """All envelopes, found by a full scan; erased says whether a page held the subject, erasure_run names the run
    where it did."""
    if not re.fullmatch(r"[0-9]{1,20}", subject):
        raise ValueError("subject is no id")
    hit = F.coalesce(F.col("payload").rlike(rf"(?<![0-9]){subject}(?![0-9])"), F.lit(False))
    out = envelopes.withColumn("erased", hit).withColumn("payload", scrub(F.col("payload"), subject))
    return out.withColumn("erasure_run", F.when(F.col("erased"), F.lit(run_id)))


def remaining(envelopes: DataFrame, subject: str) -> int:
    """Pages that still hold the subject: 0 once an erasure is complete."""
    return envelopes.where(F.col("payload").rlike(rf"(?<![0-9]){subject}(?![0-9])")).count()


def mark_suppressed(subjects: DataFrame, key: bytes, column: str = "subject") -> DataFrame:
    """(token) of each subject; the id itself isn't kept."""
    return subjects.select(S.subject_tokens(key, F.col(column)).alias("token")).distinct()


def suppress(rows: DataFrame, tokens: DataFrame, column: str = "token") -> DataFrame:
    """Rows whose subject token isn't suppressed."""
    return rows.join(tokens.select(column).distinct(), column, "left_anti")
