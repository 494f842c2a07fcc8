"""Quality classifier: heuristic labellers, expectation-maximisation over their votes, a hashed linear scorer."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from assay.llm.words import _BYTE, byte_runs, mix, word_hashes

BAD, GOOD, SILENT = 0, 1, 2
BUCKETS = 1 << 13
SAMPLE_ROWS = 20_000
_U = np.uint64

# Shape class of each byte: capitals, other letters, digits; every other byte stands for itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91] = 65
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[48:58] = 48
_PROSE = np.zeros(256, bool)
_PROSE[[ord(c) for c in ".,;:'\"!?()-@/+_"]] = True


@dataclass(frozen=True)
class Labeller:
    """Votes bad or good where a text's measure leaves the silent range between two limits."""

    name: str
    measure: str
    bad_from: float
    good_to: float

    def vote(self, values: np.ndarray) -> np.ndarray:
        rising = not self.bad_from < self.good_to
        bad = values >= self.bad_from if rising else values <= self.bad_from
        good = values <= self.good_to if rising else values >= self.good_to
        return np.where(bad, BAD, np.where(good, GOOD, SILENT))


# Each defect has a labeller that votes bad or stays silent; only whole prose earns a vote for good.
NEVER = float("nan")
LABELLERS = (
    Labeller("symbols", "symbol_share", 0.08, NEVER),
    Labeller("shouting", "capital_share", 0.5, NEVER),
    Labeller("stutter", "same_as_before", 0.25, NEVER),
    Labeller("one_word", "top_word_share", 0.25, NEVER),
    Labeller("odd_words", "odd_word_share", 0.3, NEVER),
    Labeller("exclaiming", "exclaim_share", 0.3, NEVER),
    Labeller("too_short", "too_short", 1.0, NEVER),
    Labeller("prose", "prose", 0.5, 0.8),
)


def measures(raws: list[bytes]) -> pd.DataFrame:
    """The labellers' measures of a run of texts; a text without words is too short and otherwise without defects."""
    hashes, first, begin, end = word_hashes(raws)
    joined = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws])])

    def per_doc(flags: np.ndarray, borders: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[borders[1:]] - total[borders[:-1]]

    shape = _SHAPE[joined]
    letter = (shape == 65) | (shape == 97)
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    odd = ~(letter | (shape == 48) | space | _PROSE[joined])
    n_words = np.diff(first)
    n_bytes = np.maximum(per_doc(~space, offsets), 1)
    n_letters = np.maximum(per_doc(letter, offsets), 1)
    letters_before = np.concatenate([[0], np.cumsum(letter, dtype=np.int64)])
    digits_before = np.concatenate([[0], np.cumsum(shape == 48, dtype=np.int64)])
    odd_before = np.concatenate([[0], np.cumsum(odd, dtype=np.int64)])
    letters = letters_before[end] - letters_before[begin]
    digits = digits_before[end] - digits_before[begin]
    plain = (letters + digits > 0) & (odd_before[end] == odd_before[begin])
    repeat = np.zeros(len(hashes), bool)
    repeat[1:] = hashes[1:] == hashes[:-1]
    repeat[first[:-1][n_words > 0]] = False
    last = joined[end - 1] if len(end) else joined[:0]
    some = np.maximum(n_words, 1)
    top = np.array([
        np.unique(hashes[a:b], return_counts=True)[1].max() if b > a else 0 for a, b in zip(first[:-1].tolist(), first[1:].tolist())
    ])
    stutter, capitals, plain_share = per_doc(repeat, first) / some, per_doc(shape == 65, offsets) / n_letters, per_doc(plain, first) / some
    return pd.DataFrame({
        "symbol_share": per_doc(odd, offsets) / n_bytes,
        "capital_share": capitals,
        "same_as_before": stutter,
        "top_word_share": np.where(n_words >= 8, top / some, 0.0),
        "odd_word_share": 1 - plain_share,
        "exclaim_share": per_doc(last == ord("!"), first) / some,
        "too_short": (n_words < 4).astype(float),
        "prose": np.minimum(plain_share, 1 - np.maximum(stutter, capitals)),
    })


def votes_of(raws: list[bytes]) -> np.ndarray:
    """One vote pattern per text: the labellers' votes as digits to base three."""
    m = measures(raws)
    out = np.zeros(len(m), np.int64)
    for lab in LABELLERS:
        out = out * 3 + lab.vote(m[lab.measure].to_numpy())
    return out


def pattern_votes(patterns: np.ndarray) -> np.ndarray:
    """Votes (rows) of the labellers (columns) in each pattern."""
    n = len(LABELLERS)
    return np.stack([patterns // 3 ** (n - 1 - j) % 3 for j in range(n)], 1).astype(int)


@dataclass
class LabelModel:
    """Class share and each labeller's chance of each vote under either class."""

    share_good: float
    chance: np.ndarray  # labeller x class x vote

    @staticmethod
    def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> "LabelModel":
        """Expectation-maximisation from the majority vote on, over counted vote patterns."""
        good, bad = (votes == GOOD).sum(1), (votes == BAD).sum(1)
        belief = np.where(good + bad > 0, (good + 1) / (good + bad + 2), 0.5)
        belief = np.where(bad == 0, 0.95, np.where(bad >= 2, 0.1, belief))
        model = LabelModel(0.5, np.full((votes.shape[1], 2, 3), 1 / 3))
        for _ in range(rounds):
            weight = np.stack([counts * (1 - belief), counts * belief])
            model.share_good = float((weight[1].sum() + 1) / (counts.sum() + 2))
            for vote in (BAD, GOOD, SILENT):
                model.chance[:, :, vote] = (weight @ (votes == vote)).T
            model.chance += 1.0
            model.chance /= model.chance.sum(2, keepdims=True)
            new = model.belief(votes)
            done = np.abs(new - belief).max(initial=0) < 1e-9
            belief = new
            if done:
                break
        return model

    def belief(self, votes: np.ndarray) -> np.ndarray:
        """Posterior chance of being good."""
        odds = np.full(len(votes), np.log(self.share_good / (1 - self.share_good)))
        for j in range(votes.shape[1]):
            odds += np.log(self.chance[j, 1, votes[:, j]]) - np.log(self.chance[j, 0, votes[:, j]])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracies(self) -> dict[str, float]:
        """Share of right votes of each labeller among the votes it is expected to cast."""
        share = np.array([1 - self.share_good, self.share_good])
        right = self.chance[:, BAD, BAD] * share[0] + self.chance[:, GOOD, GOOD] * share[1]
        cast = (self.chance[:, :, :2].sum(2) * share).sum(1)
        return {lab.name: float(a) for lab, a in zip(LABELLERS, right / cast)}


def features(raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, weight) of each text: hashed word shapes, shape pairs and repeats, as shares of its words."""
    hashes, first, begin, end = word_hashes(raws)
    joined = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
    shape = _SHAPE[joined]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[begin] = True
    place = np.cumsum(keep) - 1
    power = np.full(int(place[-1]) + 1, 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = power.cumprod(dtype=np.uint64)
    inverse = np.full(len(power), pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    inverse = inverse.cumprod(dtype=np.uint64)
    total = np.cumsum(np.where(keep, _BYTE[shape] * power[place], _U(0)), dtype=np.uint64)
    before = np.where(begin > 0, total[begin - 1], _U(0)) if len(begin) else np.zeros(0, np.uint64)
    shapes = mix(((total[end - 1] if len(end) else before) - before) * inverse[place[begin]])
    pairs = mix(shapes[:-1] * _U(3) + shapes[1:] * _U(7)) if len(shapes) else shapes
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if a == b:
            out.append((np.zeros(0, np.int64), np.zeros(0)))
            continue
        repeats = np.full(int(again[a + 1 : b].sum()), 1, np.uint64)
        all_keys = np.concatenate([shapes[a:b], pairs[a : b - 1], repeats])
        bucket, n = np.unique((all_keys % _U(BUCKETS)).astype(np.int64), return_counts=True)
        weight = np.sqrt(n / (b - a))
        out.append((bucket, weight / np.sqrt((weight**2).sum())))
    return out


@dataclass
class Scorer:
    """Linear scorer over hashed features; above one half is good."""

    weights: np.ndarray
    bias: float

    @staticmethod
    def fit(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, epochs: int = 8, rate: float = 1.0, decay: float = 1e-6) -> "Scorer":
        """Logistic regression on soft labels by gradient steps with per-weight rates, in a fixed order."""
        w, b = np.zeros(BUCKETS), 0.0
        seen, seen_b = np.full(BUCKETS, 1e-6), 1e-6
        order = np.random.default_rng(5)
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                at, x = rows[i]
                error = 1 / (1 + np.exp(-np.clip(w[at] @ x + b, -30, 30))) - target[i]
                grad = error * x + decay * w[at]
                seen[at] += grad * grad
                seen_b += error * error
                w[at] -= rate * grad / np.sqrt(seen[at])
                b -= 0.1 * rate * error / np.sqrt(seen_b)
        return Scorer(w, float(b))

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Chance of being good; a text without words scores zero."""
        z = np.array([self.weights[at] @ x + self.bias for at, x in rows])
        empty = np.array([len(at) == 0 for at, _ in rows], bool)
        return np.where(empty, 0.0, 1 / (1 + np.exp(-np.clip(z, -30, 30))))


@dataclass
class QualityModel:
    labels: LabelModel
    scorer: Scorer


def fit(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Label model from the vote patterns of all documents, scorer from a bounded sample.

    Votes are counted over every row; the table of patterns has 3^8 rows at most. The scorer is trained on
    the ``sample_rows`` texts with the least text hash, labelled by their patterns' posterior; features of
    the sample are made where the texts are. An empty table gives a model that accepts any text with words.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(3 ** len(LABELLERS), np.int64)
        for batch in batches:
            for _, _, raws in byte_runs(batch["text"]):
                total += np.bincount(votes_of(raws), minlength=len(total))
        some = np.flatnonzero(total)
        yield pd.DataFrame({"pattern": some, "n": total[some]})

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b, raws in byte_runs(batch["text"]):
                rows = features(raws)
                yield pd.DataFrame({
                    "place": batch["place"].iloc[a:b].to_numpy(), "pattern": votes_of(raws),
                    "at": [r[0].astype(np.int32).tobytes() for r in rows], "x": [r[1].astype(np.float32).tobytes() for r in rows],
                })

    texts = docs.select(F.col(text_col).alias("text"))
    counted = texts.mapInPandas(count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    if not len(counted):
        return QualityModel(LabelModel(0.5, np.full((len(LABELLERS), 2, 3), 1 / 3)), Scorer(np.zeros(BUCKETS), 1.0))
    votes = pattern_votes(counted["pattern"].to_numpy())
    labels = LabelModel.fit(votes, counted["n"].to_numpy())

    n = int(counted["n"].sum())
    keyed = texts.withColumn("place", F.xxhash64("text")).filter("text is not null")
    if n > 2 * sample_rows:  # a thin slice of the hash range that holds the sample almost surely
        share = 2.0 * sample_rows / n
        keyed = keyed.filter(F.col("place") < F.lit(int(-(2**63) + share * 2**64)))
    rows = keyed.mapInPandas(sample, "place long, pattern long, at binary, x binary")
    drawn = rows.orderBy("place", "pattern").limit(sample_rows).toPandas()
    belief = labels.belief(pattern_votes(drawn["pattern"].to_numpy()))
    return QualityModel(labels, Scorer.fit([(np.frombuffer(a, np.int32), np.frombuffer(x, np.float32).astype(float)) for a, x in zip(drawn["at"], drawn["x"])], belief))


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with quality_score and accepted (score of one half or more).

    A null or wordless text scores zero and is rejected. Columns of these names in ``docs`` are replaced.
    """
    base = docs.drop("quality_score", "accepted")

    def work(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            parts = [model.scorer.score(features(raws)) for _, _, raws in byte_runs(text)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    scorer = F.pandas_udf(work, "double")
    scored = base.withColumn("quality_score", scorer(F.col(text_col)))
    return scored.withColumn("accepted", F.col("quality_score") >= 0.5)


def classify(docs: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on ``docs`` and score them; see fit() and score()."""
    return score(docs, fit(docs, text_col, sample_rows), text_col)
