"""Quality by weak supervision.

Rules look at measures of a text and vote keep (1), reject (-1) or abstain (0).
Which rules can be trusted is not set by hand: expectation-maximisation over the
counts of vote patterns estimates how often each rule is right, and the posterior
probability of being good, given all votes and accuracies, decides.  With R rules there are at most 3^R patterns, whatever the number of
texts, so the model is fitted on a table of fixed size that Spark counts.

Texts that fail the base rule (fewer than 10 words, or over 20 % of the words inside
repeated five-word windows) are never kept.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import hidden, register, shown, table

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_letters long, n_lines long, n_ended long, n_distinct long"
NAMES = [c.split()[0] for c in MEASURES.split(", ")]
CLOSE, ROUNDS = 1e-9, 200
ACCURACY, TRUST = 0.9, 20  # accuracy of every rule that the fit starts from, and the votes that say so
LEAST, MOST = 0.55, 0.995
KEEP = 0.5


def measure_text(text: str) -> tuple:
    """Measures of one text; words are runs of anything but the six ASCII blanks."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "surrogatepass"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split()]
    repeat = 0
    if n > WINDOW:
        grams = list(zip(*[words[i:] for i in range(WINDOW)], strict=False))
        if len(set(grams)) < len(grams):
            twice, reach = Counter(grams), 0
            for i, g in enumerate(grams):
                if twice[g] > 1:
                    repeat += i + WINDOW - max(i, reach)
                    reach = i + WINDOW
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(raw) - len(raw.translate(None, _LETTERS))
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(raw) - len(raw.translate(None, _UPPER))
    ended = sum(x.rstrip().endswith((b".", b"!", b"?", b'"', b":")) for x in lines)
    return n, chars, symbols, len(lines) - len(set(lines)), repeat, upper, letters, len(lines), ended, len(set(words))


_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the struct ``_m`` of measures."""

    @F.pandas_udf(MEASURES)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([measure_text(x or "") for x in batch], columns=NAMES)

    return docs.withColumn("_m", run(text))


def votes(m: str = "_m") -> dict[str, Column]:
    """Each rule's vote on the measures.

    Every fault has a rule that rejects or abstains; one rule speaks for running prose
    and abstains otherwise.  A rule that would praise the mere absence of its fault
    would outvote the one rule that sees another fault.
    """
    v = {c: F.col(f"{m}.{c}") for c in NAMES}
    n, lines, letters = v["n_words"], F.greatest(v["n_lines"], F.lit(1)), F.greatest(v["n_letters"], F.lit(1))
    per_word = F.greatest(n, F.lit(1))
    faults = {
        "length": n < 10,
        "word_length": (v["word_chars"] < 2 * n) | (v["word_chars"] > 14 * n),
        "symbols": v["n_symbols"] / per_word > 0.1,
        "lines": v["n_dup_lines"] / lines > 0.5,
        "repeats": v["n_repeat_words"] / per_word > 0.2,
        "capitals": v["n_upper"] / letters > 0.5,
        "endings": (v["n_lines"] >= 3) & (v["n_ended"] / lines < 0.1),
        "variety": (v["n_distinct"] / per_word < 0.15) & (n < 300),
    }
    prose = (n >= 10) & (v["n_ended"] / lines >= 0.5) & (v["n_symbols"] / per_word <= 0.05)
    prose = prose & (v["n_upper"] / letters <= 0.2) & v["word_chars"].between(3 * n, 9 * n)
    return {k: F.when(bad, -1).otherwise(0) for k, bad in faults.items()} | {"prose": F.when(prose, 1).otherwise(0)}


def fit(patterns: dict[tuple, int]) -> list[float]:
    """Accuracy of every rule (how often it is right when it votes), by expectation-maximisation.

    Good and bad are equally likely before any vote, abstentions say nothing, and a rule
    is never taken to be worse than chance, so good cannot turn into bad.  ``TRUST``
    imagined votes of accuracy ``ACCURACY`` keep rules that hardly vote in place.  Sums
    run in the order of the patterns, so every run gives the same result.
    """
    items = sorted(patterns.items())
    accuracies = [ACCURACY] * (len(items[0][0]) if items else 0)
    for _ in range(ROUNDS):
        right, cast = [ACCURACY * TRUST] * len(accuracies), [float(TRUST)] * len(accuracies)
        for votes_, count in items:
            p = posterior(votes_, accuracies)
            for j, v in enumerate(votes_):
                if v:
                    right[j] += count * (p if v > 0 else 1 - p)
                    cast[j] += count
        new = [min(max(r / c, LEAST), MOST) for r, c in zip(right, cast, strict=True)]
        moved = max((abs(x - y) for x, y in zip(new, accuracies, strict=True)), default=0.0)
        accuracies = new
        if moved < CLOSE:
            break
    return accuracies


def weight(accuracy: float) -> float:
    return math.log(accuracy) - math.log(1 - accuracy)


def posterior(votes_: tuple, accuracies: list[float]) -> float:
    """Probability of a good text given its votes."""
    return 1 / (1 + math.exp(-sum(v * weight(a) for v, a in zip(votes_, accuracies, strict=True))))


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_m`` (measures), ``base_failed``, ``quality`` (posterior) and ``kept``.

    Reads the texts twice: once to count the vote patterns, once to judge.  A null or
    empty text has no words, fails the base rule and is not kept.  Equal texts get
    equal verdicts; an empty table stays empty.
    """
    rules = votes()
    counted = measured(docs.select(text), text).groupBy(*[v.alias(k) for k, v in rules.items()]).count()
    patterns = {tuple(r[k] for k in rules): r["count"] for r in counted.collect()}  # at most 3^rules rows
    odds = F.lit(0.0)
    for vote, accuracy in zip(rules.values(), fit(patterns), strict=False):
        odds = odds + vote * F.lit(weight(accuracy))
    n, repeat = F.col("_m.n_words"), F.col("_m.n_repeat_words")
    df = measured(docs, text).withColumns({"base_failed": (n < 10) | (100 * repeat > 20 * n), "quality": 1 / (1 + F.exp(-odds))})
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text is judged good; the columns stay as they are."""
    plain, names = hidden(docs)
    return shown(judged(plain, names[text]).filter("kept"), names)


@register("op9_quality_votes")
def query(spark: SparkSession, folder: str) -> DataFrame:
    df = judged(table(spark, folder, "documents").select("doc_id", "text"))
    return df.select("doc_id", *[F.col(f"_m.{c}").alias(c) for c in NAMES[:5]], "base_failed", "kept", "quality")
