"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and unlabelled ones (U) train a linear classifier. With the share
``prior`` of toxic texts among U, the risk of calling P toxic and U clean is corrected for the
toxic texts inside U, and the corrected part is kept from falling below zero (nnPU). The
features of a text are its words and their first characters, each counted once, however long
the text is. Features are counted over all labelled texts that aren't held out, by partial
sums; numpy trains their weights on a bounded sample of these texts; a feature that no sampled
text holds gets the weight that others have at its log ratio. Texts are scored where they lie,
without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilmart.sources.workspace import settle

THRESHOLD = 0.3
# Bounds of what is fitted on: labelled texts sampled for training, and features of the model.
MOST_POSITIVE = 4000
MOST_UNLABELLED = 12000
MOST_FEATURES = 65_536
MOST_SENT = 1_000_000  # labels that are sent to the tasks that read texts; more are joined by a shuffle
LEAST_EXCESS = 4.0
PREFIX = 4
_TOKEN = re.compile(r"\w+")


def features(text: str | None) -> set[str]:
    """Words, and the start of each longer word marked with ``^``."""
    words = set(_TOKEN.findall((text or "").lower()))
    return words | {"^" + w[:PREFIX] for w in words if len(w) > PREFIX}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        known = self.weights
        margin = self.bias + sum(known[f] for f in features(text) if f in known)
        return 1.0 / (1.0 + float(np.exp(-np.clip(margin, -30.0, 30.0))))


def held_out(key: Column) -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(4)) == 2, F.lit(False))


def _counted(texts: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Features with the toxic (``p``) and all (``u``) texts that hold them; '' counts the texts."""
    for batch in texts:
        p, u = Counter(), Counter()
        for toxic, text in zip(batch["_toxic"], batch["_text"], strict=True):
            found = features(text)
            found.add("")
            u.update(found)
            if toxic:
                p.update(found)
        yield pd.DataFrame({"f": list(u), "p": [p[f] for f in u], "u": list(u.values())})


def risk_step(scores: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The nnPU risk under the logistic loss and its slope along each text's score.

    Where the estimate of the clean texts' risk is negative, the slope follows that part
    alone, upwards, as the non-negative estimator prescribes.
    """
    called_toxic = np.logaddexp(0.0, -scores)
    called_clean = np.logaddexp(0.0, scores)
    share = 1.0 / (1.0 + np.exp(-scores))
    of_p, of_u = positive / max(positive.sum(), 1.0), (1 - positive) / max((1 - positive).sum(), 1.0)
    clean_risk = (of_u * called_clean).sum() - prior * (of_p * called_clean).sum()
    clean_slope = (of_u - prior * of_p) * share
    toxic_slope = prior * of_p * (share - 1.0)
    risk = prior * (of_p * called_toxic).sum() + max(clean_risk, 0.0)
    return risk, (toxic_slope + clean_slope if clean_risk >= 0 else -clean_slope)


def train(
    rows: list[np.ndarray], positive: np.ndarray, n_features: int, prior: float, steps: int = 300, rate: float = 0.1
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear classifier, by full-batch Adam on the nnPU risk."""
    lengths = np.array([len(r) for r in rows])
    columns = np.concatenate(rows).astype(np.int64) if len(rows) else np.zeros(0, np.int64)
    row_of = np.repeat(np.arange(len(rows)), lengths)
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        scores = np.bincount(row_of, theta[columns], len(rows)) + theta[-1]
        _, slope = risk_step(np.clip(scores, -30, 30), positive, prior)
        grad = np.append(np.bincount(columns, slope[row_of], n_features), slope.sum())
        grad[:-1] += 1e-6 * theta[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    # The bias under which the unlabelled texts' mean score is the prior.
    margins = np.bincount(row_of, theta[columns], len(rows))[positive == 0]
    low, high = -30.0, 30.0
    for _ in range(60):
        middle = (low + high) / 2
        mean = (1.0 / (1.0 + np.exp(-np.clip(margins + middle, -30, 30)))).mean() if len(margins) else prior
        low, high = (middle, high) if mean < prior else (low, middle)
    return theta[:-1], (low + high) / 2 if len(margins) else float(theta[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    prior: float | None = None,
) -> Model:
    """Train on texts and labels of rows that aren't held out.

    The sample is the first ``MOST_POSITIVE`` toxic and the first ``MOST_UNLABELLED`` of all
    labelled ids by hash. ``prior`` defaults to the share of toxic texts among the labelled ones.
    Ids labelled more than once are toxic if one label says so; NULL ids, labels and texts teach
    nothing. With no toxic example every text gets the prior as its score (0.01 without labels).
    """
    seen = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
        .groupBy(key)
        .agg(F.max(label).alias("_toxic"))
    )
    seen = settle(seen, "labels")
    known = seen.agg(F.avg("_toxic").alias("share"), F.count("*").alias("n")).first()
    prior = min(max(known["share"] if prior is None and known["share"] is not None else prior or 0.01, 1e-3), 0.5)
    texts = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(key)))
    texts = texts.select(F.col(key), F.col(text).alias("_text"))
    labelled = texts.join(F.broadcast(seen) if known["n"] <= MOST_SENT else seen, key)
    counts = labelled.select("_toxic", "_text").mapInPandas(_counted, "f string, p bigint, u bigint")
    counts = settle(counts.groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where("p >= 2 or f = ''"), "features")
    totals = counts.where("f = ''").first()
    n_p, n_u = (float(totals["p"]), float(totals["u"])) if totals else (0.0, 0.0)
    if not n_p:
        return Model({}, float(np.log(prior / (1 - prior))))
    # Features that toxic texts hold far more often than all texts, by standard deviations.
    expected = n_p * (F.col("u") + 0.5) / (n_u + 1)
    excess = (F.col("p") - expected) / F.sqrt(expected + 1.0)
    chosen = counts.where((F.col("p") >= 2) & (F.col("f") != "") & (excess >= LEAST_EXCESS)).orderBy(excess.desc(), "f").limit(MOST_FEATURES).collect()
    place = {r["f"]: i for i, r in enumerate(chosen)}
    ratio = np.array([np.log((r["p"] + 0.5) / (n_p + 1)) - np.log((r["u"] + 0.5) / (n_u + 1)) for r in chosen])

    def indexed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [sorted(place[f] for f in features(t) if f in place) for t in b["_text"]]
            yield pd.DataFrame({"_row": b["_row"], "_positive": b["_positive"], "_found": found})

    order = F.xxhash64(F.lit(7), F.col(key))
    positive = seen.where("_toxic = 1").orderBy(order).limit(MOST_POSITIVE).select(key, F.lit(1.0).alias("_positive"))
    # U stands for all texts, the confirmed ones among them; only then does ``prior`` hold for it.
    unlabelled = seen.orderBy(order).limit(MOST_UNLABELLED).select(key, F.lit(0.0).alias("_positive"))
    # At most MOST_POSITIVE + MOST_UNLABELLED ids, so the texts need not move to meet them.
    sample = texts.join(F.broadcast(positive.unionByName(unlabelled)), key).select(F.xxhash64(key).alias("_row"), "_positive", "_text")
    table = sample.mapInPandas(indexed, "_row bigint, _positive double, _found array<int>").toPandas()
    table = table.sort_values(["_positive", "_row"], kind="stable")
    rows = [np.asarray(x, dtype=np.int64) for x in table["_found"]]
    weights, bias = train(rows, table["_positive"].to_numpy(), len(chosen), prior)
    met = np.isin(np.arange(len(chosen)), np.concatenate([r for r, p in zip(rows, table["_positive"], strict=True) if p] or [np.zeros(0)]))
    slope = max(float(weights[met] @ ratio[met]), 0.0) / max(float(ratio[met] @ ratio[met]), 1e-9)
    weights = np.where(met, weights, slope * ratio)
    return Model({r["f"]: float(w) for r, w in zip(chosen, weights, strict=True)}, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD`` on) to every row.

    The whole text is read; a NULL or empty one has no feature and gets the score of the bias.
    Columns of ``docs`` named ``score`` or ``predicted`` are replaced.
    """
    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")  # sent with at most MOST_FEATURES weights

    kept = docs.drop("score", "predicted")
    return kept.withColumn("score", scored(F.col(text))).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
