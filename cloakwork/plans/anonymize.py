"""Global anonymization end to end: code, partition, generalize, decode, summarize."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.functions.scalar import format_interval
from cloakwork.operators import encode
from cloakwork.operators.mondrian import Classes, mondrian, ncp_percent
from cloakwork.roles import AnonSpec


@dataclass(frozen=True)
class Anonymized:
    rows: DataFrame
    classes: Classes
    ncp: DataFrame
    seconds: float


def global_anonymize(df: DataFrame, spec: AnonSpec, key: str, interval_format: str = "number") -> Anonymized:
    """Quasi-identifiers to generalized texts, identifiers removed, sensitive attribute kept.

    Categorical columns are coded by first appearance in ``key`` order; a class shows
    the labels of its code range joined by the delimiter.  ``interval_format`` is
    ``number`` (whole numbers, truncated) or ``exact``.
    """
    start = time.time()
    codes = encode.fit_first_codes(df, list(spec.categorical), key)
    coded = codes.apply(spec.project(df, keep=(key,) if key not in spec.qi else ()))
    classes = mondrian(coded, list(spec.qi), spec.k, spec.strict)
    boxes, texts = classes.generalize(coded, key), []
    for c in spec.qi:
        lo, hi = f"{c}_min", f"{c}_max"
        if c in spec.categorical:
            boxes = codes.decode_spans(boxes, c, lo, hi, f"{c}__text", spec.delimiter)
            texts.append(F.col(f"{c}__text").alias(c))
        else:
            texts.append(format_interval(lo, hi, interval_format, spec.delimiter).alias(c))
    rows = boxes.select(*texts, spec.sa)
    loss = ncp_percent(classes.table(), list(spec.qi), classes.ranges)
    return Anonymized(rows, classes, loss, time.time() - start)


def run_summary(results: list[tuple[str, Anonymized, AnonSpec]], spark: SparkSession) -> DataFrame:
    """One line per anonymized dataset."""
    out = None
    for name, r, spec in results:
        line = r.ncp.select(
            F.lit(name).alias("dataset"),
            "ncp_percent",
            "n_classes",
            "n_records",
            F.lit(len(spec.qi)).alias("n_qi"),
            F.lit(spec.sa).alias("sa"),
            F.lit(spec.k).alias("k"),
            F.lit(r.seconds).alias("seconds"),
        )
        out = line if out is None else out.unionByName(line)
    return out
