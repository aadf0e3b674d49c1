"""Toxicity by weak supervision.

1. Voters. Each voter is a lexicon or a pattern of its own kind; it votes toxic on a text, and some also vote
   against it where they find nothing. Five lexicons of insults, by what they say, and six patterns are given
   below. Five more lexicons are mined from labelled training rows of any language: words that occur in
   toxic rows only, words that occur hardly anywhere else, and word beginnings of three lengths. Near copies
   (rows that share their least word hash) count as one row in mining.
2. Generative label model. Means and second moments of the votes are summed over all texts (a
   matrix of the voters' number squared, whatever the size of the corpus). Conditionally
   independent voters have a rank-one covariance off the diagonal; its factor gives each voter's
   accuracy (rates on toxic and on other texts), what it leaves unexplained gives the pairwise
   correlations, and correlated pairs are masked and the factor is fitted again. A text's posterior
   adds the voters' log-odds, damped by their correlations.
3. Classifier. A logistic model on entries, patterns, hit counts and densities, not on the lexicons' votes, is trained
   on the posteriors of all texts of the corpus, labelled or not: no label is a target. Texts with the
   same features are one row with a count; each step sums loss and gradient over all rows, and the driver
   takes quasi-Newton steps.

Labels are read only from training rows, and only to mine entries and count the share of toxic rows; language,
source and ids are never inputs of a score. The model (a few KB) is broadcast; scoring is one pass without a shuffle.

Edge cases: null and empty texts get the model's score of no evidence; rows that repeat get the
same score; labels that are null are left out, contradicting labels of one id count as toxic; a null id is never labelled;
without any labelled toxic row only the fixed voters work; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import forget, lean, summed, table, written

#: Labelled rows that entries are mined from, at most.
MAX_LABELLED = 20_000
#: Entries that are mined, at most; toxic rows an entry must occur in; and how much more often than in other rows.
MAX_ENTRIES, MIN_ROWS, MIN_LIFT = 600, 4, 20
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
L2, STEPS = 1e-3, 25

#: Rates of votes on toxic and on other texts that voters are given before data, and the texts that counts for.
USUAL_RATES, USUAL_TEXTS = (0.25, 0.01), 500

#: Insults that voters know without labels, by what they say of a person.
INSULTS = {
    "stupid": "idiot idiotic imbecile moron moronic cretin dumb dumbass fool retard retarded stupid clown",
    "worthless": "worthless loser lowlife pathetic garbage trash rubbish scum scumbag crap",
    "repulsive": "vermin parasite maggot filth filthy disgusting repulsive vile degenerate freak ugly nasty",
    "obscene": "arse arsehole asshole bastard bitch bullshit damn dickhead fuck fucker fucking jerk prick psycho shit shitty sucker cunt pussy twat slut whore",
    "hostile": "fag faggot nigger hate hateful",
}
#: Digits and signs that stand for letters in masked spellings.
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
#: Lexicons that are mined, the fixed ones, and patterns over both: one voter each.
MINED = ("words of toxic rows only", "words rare elsewhere", *(f"beginnings of {n}" for n in PREFIXES))
PATTERNS = ("masked spelling of an insult", "insult after you are", "insult in capitals", "three or more hits", "hits over 2 % of the words", "two or more different hits")
VOTERS = (*MINED, *INSULTS, *PATTERNS)
_MASKED, _YOU, _CAPITALS, _THREE, _DENSE, _TWO = range(len(VOTERS) - len(PATTERNS), len(VOTERS))
#: Voters whose silence speaks against toxic; the others just abstain.
TWO_SIDED = np.array([v in MINED or i in (_THREE, _TWO) for i, v in enumerate(VOTERS)])

_KEPT = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_UNMASKED = bytes(ord(chr(b).translate(LOOKALIKES)) if b < 128 and chr(b).translate(LOOKALIKES) != chr(b) else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INSULTS = frozenset(w.encode() for words in INSULTS.values() for w in words.split())
_YOU_ARE = re.compile(rb"\byou (?:are|re)(?: an?| so| such an?)? (%s)\b" % b"|".join(sorted(_INSULTS)))
#: Words a worker remembers the entries of.
MEMO_WORDS = 100_000


def words_of(text: str) -> list[bytes]:
    """Lower-case words: runs of a-z and of characters beyond ASCII."""
    return text.lower().encode("utf-8", "replace").translate(_KEPT).split()


def entries_of(words: list[bytes]) -> set[bytes]:
    """Words, and word beginnings (of so many bytes) written with a trailing bar."""
    distinct = set(words)
    found = set(distinct)
    for n in PREFIXES:
        found.update(w[:n] + b"|" for w in distinct if len(w) > n)
    return found


def known_entries(mined: dict[bytes, bool]) -> dict[bytes, tuple[int, ...]]:
    """Entry -> its voters. ``mined``: entry -> whether it occurs in no other row."""
    voters: dict[bytes, tuple[int, ...]] = {}
    for e, only in mined.items():
        voters[e] = (2 + PREFIXES.index(len(e) - 1),) if e.endswith(b"|") else (0,) if only else (1,)
    for i, words in enumerate(INSULTS.values()):
        for w in words.split():
            voters[w.encode()] = (*voters.get(w.encode(), ()), len(MINED) + i)
    return voters


@dataclass
class Model:
    entries: dict[bytes, tuple[int, ...]]
    """Entry -> the voters whose lexicon has it; the order numbers the entries."""
    rates: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    """Of each voter: rate of votes on toxic texts, on others."""
    correlations: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    prior: float = 0.1
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def votes_at(self) -> slice:
        return slice(len(self.entries), len(self.entries) + len(VOTERS))

    @property
    def n_features(self) -> int:
        return len(self.entries) + len(VOTERS) + 4

    @cached_property
    def learned(self) -> np.ndarray:
        """Which features the classifier sees: all but the lexicons' votes, which the posterior is made of."""
        seen = np.ones(self.n_features, bool)
        seen[len(self.entries) : len(self.entries) + _MASKED] = False
        return seen

    @cached_property
    def memo(self) -> dict[bytes, tuple[int, ...]]:
        known = {e: i for i, e in enumerate(self.entries)}

        class Memo(dict):
            def __missing__(self, w: bytes) -> tuple[int, ...]:
                out = tuple(known[e] for e in entries_of([w]) if e in known)
                if len(self) < MEMO_WORDS:
                    self[w] = out
                return out

        return Memo()

    @cached_property
    def voters(self) -> list[tuple[int, ...]]:
        return list(self.entries.values())

    def evidence(self, text: str | None) -> np.ndarray:
        """Features of a text: entries, votes (0/1), counts and a constant."""
        text = text or ""
        words = words_of(text)
        memo = self.memo
        hit = {w: found for w in set(words) if (found := memo[w])}
        x = np.zeros(self.n_features, np.float32)
        votes = x[self.votes_at]
        n_hits, n_distinct = 0, 0
        if hit:
            distinct = {e for found in hit.values() for e in found}
            n_hits, n_distinct = sum(map(hit.__contains__, words)), len(distinct)
            x[list(distinct)] = 1
            votes[[v for e in distinct for v in self.voters[e]]] = 1
            votes[_YOU] = _YOU_ARE.search(b" ".join(words)) is not None
            votes[_CAPITALS] = any(w.isupper() and w.lower().encode() in _INSULTS for w in text.split()) if not text.isupper() else 0
            votes[_THREE] = n_hits >= 3
            votes[_DENSE] = n_hits > 0.02 * len(words)
            votes[_TWO] = len(hit) >= 2
        if masked := _INSULTS.intersection(text.lower().encode("utf-8", "replace").translate(_UNMASKED).split()):
            votes[_MASKED] = not masked.issubset(words)
        x[-4:] = (np.log1p(n_distinct), np.log1p(n_hits), min(1.0, 20 * n_hits / (len(words) + 5)), 1.0)
        return x

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Of (n, voters) votes: probability of toxic under the generative model."""
        on, off = self.rates[:, 0], self.rates[:, 1]
        damp = 1 / (1 + np.clip(np.abs(self.correlations), 0, 1).sum(axis=1))
        odds = votes * (np.log(on / off) * damp) + TWO_SIDED * (1 - votes) * (np.log((1 - on) / (1 - off)) * damp)
        return 1 / (1 + np.exp(-np.clip(np.log(self.prior / (1 - self.prior)) + odds.sum(axis=1), -30, 30)))

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


def label_model(moments: np.ndarray, n: int, prior: float, rounds: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(rates, correlations) of the voters from ``moments`` (sums of products of votes, the sums themselves on the diagonal)."""
    k = len(moments)
    second = moments / max(n, 1)
    mean = np.diag(second).copy()
    cov = second - np.outer(mean, mean)
    spread = np.sqrt(np.clip(mean * (1 - mean), 1e-12, None))
    live = (mean > 0) & (mean < 1)
    use = np.outer(live, live) & ~np.eye(k, dtype=bool)
    factor = np.zeros(k)
    for j in np.flatnonzero(live):  # the median over pairs of other voters isn't moved by a few correlated ones
        rest = [i for i in np.flatnonzero(live) if i != j]
        triples = [cov[j, a] * cov[j, b] / cov[a, b] for i, a in enumerate(rest) for b in rest[:i] if abs(cov[a, b]) > 1e-12]
        factor[j] = np.sqrt(max(0.0, float(np.median(triples)))) if triples else 0.0
    loose = np.zeros((k, k))
    for _ in range(rounds):
        loose = np.where(np.outer(live, live), (cov - np.outer(factor, factor)) / np.outer(spread, spread), 0.0)
        np.fill_diagonal(loose, 0.0)
        limit = max(0.1, 3 * float(np.median(np.abs(loose[use])))) if use.any() else 0.1
        new = np.outer(live, live) & ~np.eye(k, dtype=bool) & (np.abs(loose) <= limit)
        for _ in range(50):  # least squares over the pairs that the factor explains, a voter at a time
            for j in np.flatnonzero(live):
                weight = (factor[new[j]] ** 2).sum()
                if weight > 0:
                    factor[j] = max(0.0, (cov[j, new[j]] * factor[new[j]]).sum() / weight)
        if (new == use).all():
            break
        use = new
    lift = factor / np.sqrt(prior * (1 - prior))
    on, off = np.clip(mean + (1 - prior) * lift, 1e-4, 1 - 1e-4), np.clip(mean - prior * lift, 1e-4, 1 - 1e-4)
    rates = np.stack([np.maximum(on, off), np.minimum(on, off)], axis=1)
    rates = (n * rates + USUAL_TEXTS * np.array(USUAL_RATES)) / (n + USUAL_TEXTS)
    return rates, np.where(np.abs(loose) > 0.05, loose, 0.0)


def loss_sums(x: np.ndarray, y: np.ndarray, n: np.ndarray, w: np.ndarray) -> np.ndarray:
    """(loss, gradient) of the cross-entropy with soft targets ``y``, summed over rows that count ``n`` times."""
    f = np.clip(x @ w, -30, 30)
    return np.concatenate([[(n * (np.logaddexp(0, f) - y * f)).sum()], x.T @ (n * (1 / (1 + np.exp(-f)) - y))])


def minimise(at, size: int, steps: int = STEPS, memory: int = 10, tolerance: float = 1e-5) -> np.ndarray:
    """Limited-memory quasi-Newton descent from zero; ``at`` gives (loss, gradient) at weights and costs one pass over the rows."""
    w = np.zeros(size)
    loss, g = at(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(g).max(initial=0) < tolerance:
            break
        d, back = g.copy(), []
        for s, y in reversed(pairs):
            back.append((s @ d) / (s @ y))
            d -= back[-1] * y
        d *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, np.sqrt(g @ g))
        for (s, y), a in zip(pairs, reversed(back), strict=True):
            d += (a - (y @ d) / (s @ y)) * s
        rate = 1.0
        for _ in range(6):
            there = at(w - rate * d)
            if there[0] <= loss - 1e-4 * rate * (g @ d):
                break
            rate /= 4
        else:
            break
        s, y = -rate * d, there[1] - g
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        w, (loss, g) = w + s, there
    return w


def fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def known_labels(labels: DataFrame, id_col: str, label_col: str, max_labelled: int, folds: int, held: int) -> DataFrame:
    """(_id, label) of at most ``max_labelled`` labelled ids whose crc32 mod ``folds`` isn't ``held``; which ones: by a hash of the id."""
    return (
        labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .filter(fold(id_col, folds) != held)
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.max(label_col).cast("int").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(max_labelled)
    )


def training_rows(docs: DataFrame, known: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(text, label) of the known ids; ``known`` has a bounded number of pairs of numbers, so it is broadcast."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(known), "_id").select("text", "label")


def mine_entries(rows: DataFrame, max_entries: int = MAX_ENTRIES, min_rows: int = MIN_ROWS) -> tuple[dict[bytes, bool], float]:
    """(entry -> whether it is in no other row, strongest first; share of toxic rows): words and beginnings that mark toxic training rows.

    Rows that share their least word hash are mostly near copies and count as one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, label in zip(b.column("text").to_pylist(), b.column("label").to_pylist(), strict=True):
                words = words_of(text)
                found = [*entries_of(words), b""]
                least = min(map(zlib.crc32, words), default=0)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([least] * len(found), pa.int64()), pa.array([label] * len(found), pa.int32())], names=["entry", "least", "label"])

    seen = rows.mapInArrow(lean(run), "entry binary, least long, label int").groupBy("entry", "least", "label").agg(F.count(F.lit(1)).alias("n"))
    seen = seen.groupBy("entry").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other"), F.sum(F.col("n") * F.col("label")).alias("rows_toxic"), F.sum("n").alias("rows"))
    seen = written(seen, "toxicity-entries")
    total = seen.filter(F.octet_length("entry") == 0).first()
    if not total or not total["toxic"]:
        return {}, 0.1
    rate_on = (F.col("toxic") + 0.5) / (total["toxic"] + 1.0)
    rate_off = (F.col("other") + 0.5) / (total["other"] + 1.0)
    strong = (
        seen.filter((F.col("toxic") >= min_rows) & (F.octet_length("entry") > 0) & (rate_on > MIN_LIFT * rate_off))
        .orderBy((F.col("toxic") * F.log(rate_on / rate_off)).desc(), "entry")
        .limit(max_entries)
    )
    found = {bytes(r["entry"]): (r["toxic"], r["other"]) for r in strong.collect()}
    forget(seen)

    def adds(e: bytes) -> bool:  # a beginning that is hardly in more rows than one of its words says nothing beyond it
        return not e.endswith(b"|") or found[e][0] >= min_rows + max((n for w, (n, _) in found.items() if w[-1:] != b"|" and w.startswith(e[:-1])), default=0)

    return {e: other == 0 for e, (_, other) in found.items() if adds(e)}, min(0.5, max(0.01, total["rows_toxic"] / total["rows"]))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    folds: int = 4, held: int = 2, max_labelled: int = MAX_LABELLED,
) -> tuple[Model, DataFrame]:
    """(model, (id, at, value) of all rows of ``docs`` as a table in the shared folder); the driver gets entries and sums of fixed size."""
    spark = docs.sparkSession
    known = known_labels(labels, id_col, label_col, max_labelled, folds, held)
    mined, prior = mine_entries(training_rows(docs, known, id_col, text_col))
    model = Model(known_entries(mined), prior=prior)
    featured = written(features(docs, spark.sparkContext.broadcast(model), id_col, text_col), "toxicity-features")
    # most texts have no evidence at all: rows with the same features are one
    groups = written(featured.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")), "toxicity-groups")
    k, width, at = len(VOTERS), model.n_features, model.votes_at

    def moments(b: pa.RecordBatch) -> np.ndarray:
        votes = dense(b.column("at"), b.column("value"), width)[:, at].astype(np.float64)
        n = b.column("n").to_numpy(zero_copy_only=False)
        return np.concatenate([(votes.T @ (votes * n[:, None])).ravel(), [n.sum()]])

    sums = summed(groups, moments, k * k + 1)
    total = sums[-1]
    model.rates, model.correlations = label_model(sums[:-1].reshape(k, k), int(total), prior)
    shared, seen = spark.sparkContext.broadcast(model), model.learned

    def loss_at(w: np.ndarray) -> tuple[float, np.ndarray]:
        weights = spark.sparkContext.broadcast(w)

        def part(b: pa.RecordBatch) -> np.ndarray:
            x = dense(b.column("at"), b.column("value"), width)
            posterior = shared.value.posterior(x[:, at].astype(np.float64))
            return loss_sums(x, posterior, b.column("n").to_numpy(zero_copy_only=False), weights.value)

        out = summed(groups, part, 1 + width) / max(total, 1)
        return out[0] + L2 / 2 * (w @ w), np.where(seen, out[1:], 0.0) + L2 * w

    model.weights = minimise(loss_at, width)
    forget(groups)
    return model, featured


def features(docs: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """(id, at, value), a row for each row of ``docs``: the features that aren't zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                rows = [model.evidence(t.as_py()) for t in part.column("text")]
                at = [np.flatnonzero(x).astype(np.int32) for x in rows]
                values = pa.array([x[i] for x, i in zip(rows, at, strict=True)], pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(at, pa.list_(pa.int32())), values], names=["id", "at", "value"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(lean(run), f"id {docs.schema[id_col].dataType.simpleString()}, at array<int>, value array<float>")


def dense(at: pa.Array, value: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(at), width), np.float32)
    rows = np.repeat(np.arange(len(at)), np.array(at.value_lengths()))
    out[rows, at.flatten().to_numpy(zero_copy_only=False)] = value.flatten().to_numpy(zero_copy_only=False)
    return out


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        return pa.array([float(np.squeeze(model.score(model.evidence(t.as_py())))) for t in texts], pa.float64())

    return docs.withColumn(name, score(F.col(text_col)))


def scores(featured: DataFrame, model: Model) -> DataFrame:
    """(id, score) from the features of :func:`train`, without reading a text again."""
    shared = featured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            found = model.score(dense(b.column("at"), b.column("value"), model.n_features)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.float64())], names=["id", "score"])

    return featured.mapInArrow(run, f"id {featured.schema['id'].dataType.simpleString()}, score double")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, featured = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores(featured, model).select(
        F.col("id").alias("doc_id"), F.coalesce(fold("id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def non_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns kept."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(text_col).alias("_text"))
    model, featured = train(docs, labels, id_col, text_col)
    forget(featured)
    scored = with_score(rows, model, "_text", "_score")
    return scored.filter(F.col("_score") < threshold).select(*[F.col("_row").getField(c).alias(c) for c in names])
