"""Quality rules by weak supervision: rules vote or abstain, and EM says how far each is to be trusted.

Rules read counts of one text (words, symbols, repeated lines and words, letters, case, sentence ends) and vote good
(1), bad (0) or abstain in between. Their thresholds are common knowledge of web corpora's filters (mean word length of
3 to 10, a symbol for every ten words, 30 % repeated lines, 80 % letters and the like), set without a look at labels. The
model: each text is good with probability `prior`, and each rule says good, says bad or is silent with chances of its
own for good and for bad texts: its accuracy, where silence counts too. Expectation-maximisation estimates all of that
from the votes of the texts that pass the base rule, without labels; that votes for good come from good texts is all that its start says. Its data are
the vote patterns with their counts: at most 3^rules rows however many texts there are, summed before they reach the
driver. The result is the posterior probability of good; it replaces the filter in which every rule must pass, so one
false alarm doesn't condemn a text that other rules speak for.

Null and empty texts have no words: they fail the base rule. Repeated rows vote like any others. A very long text
is counted as a whole, a MB of words at a time. Ties don't arise: a verdict is a threshold on the
posterior. An empty table gives no rows and the model stays at its start. Extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces_of, stretches, texts_of, tidy, written

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
_DROP = bytes(set(range(256)) - set(SYMBOLS))
_UPPER = bytes(set(range(256)) - set(range(65, 91)))
_LOWER = bytes(set(range(256)) - set(range(97, 123)))
_STOPS = bytes(set(range(256)) - set(b".!?"))
_SHOUTS = bytes(set(range(256)) - set(b"!"))
_ODD = bytes(x for x in range(128) if not chr(x).isalpha())
_TAILS = bytes(set(range(256)) - set(range(128, 192)))


def repeat_words(ids: np.ndarray, types: int, size: int = 3) -> int:
    """Words inside runs of `size` words that occur twice or more; words are numbers below `types`."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    key = ids[:n].copy()
    for k in range(1, size):
        # Ranks stay below the number of words, so the pairs are exact.
        key = np.unique(key * types + ids[k : n + k], return_inverse=True)[1]
    often = np.flatnonzero(np.bincount(key)[key] > 1)
    if not len(often):
        return 0
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, often, 1)
    np.add.at(cover, often + size, -1)
    return int((np.cumsum(cover) > 0).sum())


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_stops", "n_shouts", "n_lines", "n_types", "n_bytes", "n_letters")


def counts_of(text: bytes) -> tuple[int, ...]:
    code: dict[bytes, int] = {}
    ids, sums = [np.zeros(0, np.int64)], np.zeros(7, np.int64)
    for piece in pieces_of(text):
        words = piece.split()
        ids.append(np.fromiter([code.setdefault(w, len(code)) for w in words], np.int64, len(words)))
        body = b"".join(words)
        sums += [len(body) - len(body.translate(None, _TAILS)), *(len(body.translate(None, drop)) for drop in (_UPPER, _LOWER, _STOPS, _SHOUTS)), len(body), len(body.translate(None, _ODD))]
    chars, upper, lower, stops, shouts, size, letters = sums.tolist()
    every = np.concatenate(ids)
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return (
        len(every), chars, len(text.translate(None, _DROP)), len(lines) - len(set(lines)), repeat_words(every, len(code)),
        upper, lower, stops, shouts, len(lines), len(code), size, letters,
    )


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the COUNTS as longs) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([counts_of(t) for a, b in stretches(batch.column(1), 1 << 20) for t in texts_of(batch.column(1).slice(a, b - a))], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.ascontiguousarray(c)) for c in rows.T)], [id_col, *COUNTS])

    return docs.select(id_col, text_col).mapInArrow(tidy(run), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass(frozen=True)
class Rule:
    """Votes good where `good` holds, else bad where `bad` holds, else abstains; SQL over the COUNTS."""

    name: str
    good: str
    bad: str


#: Of a text between the two thresholds a rule says nothing.
RULES = (
    Rule("length", "n_words BETWEEN 100 AND 100000", "n_words < 20"),
    Rule("word_length", "word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("sentences", "n_stops * 40 >= n_words AND n_stops * 4 <= n_words", "n_stops * 2 > n_words OR n_words >= 100 AND n_stops * 200 < n_words"),
    Rule("symbols", "n_symbols * 100 <= n_words", "n_symbols * 10 > n_words"),
    Rule("letters", "n_letters * 100 >= n_bytes * 90", "n_letters * 100 < n_bytes * 80"),
    Rule("repeat_words", "n_repeat_words * 100 <= n_words * 10", "n_repeat_words * 100 > n_words * 30"),
    Rule("dup_lines", "n_dup_lines * 100 <= n_lines * 10", "n_dup_lines * 100 > n_lines * 30"),
    Rule("variety", "n_types * n_types >= 16 * n_words", "n_types * n_types < 4 * n_words"),
    Rule("case", "n_upper * 10 <= n_lower", "n_upper * 2 > n_lower"),
    Rule("shouts", "n_shouts * 100 <= n_words", "n_shouts * 10 > n_words"),
)


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """One digit a rule: 0 bad, 1 good, 2 abstains."""
    return F.concat(*(F.when(F.expr(r.good), "1").when(F.expr(r.bad), "0").otherwise("2") for r in rules))


#: Start of EM, by class (bad, good): how often a rule says bad, says good, is silent. A bad text is bad in ways of its
#: own and passes most rules too, so a vote for good says little at first, a vote for bad more.
START = ((0.3, 0.5, 0.2), (0.05, 0.75, 0.2))


@dataclass
class LabelModel:
    """prior: P(good). speaks[r, y, v]: probability that rule r gives v (bad, good, abstains) for class y (bad, good)."""

    prior: float
    speaks: np.ndarray

    def posterior(self, patterns: list[str]) -> np.ndarray:
        if not patterns:
            return np.zeros(0)
        v = np.array([[int(x) for x in p] for p in patterns])
        logs = np.log(np.maximum(self.speaks, 1e-9))
        by = [logs[np.arange(v.shape[1]), y, v].sum(1) for y in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(by[1] - by[0] + np.log(self.prior / (1 - self.prior)), -500, 500)))


def learn(patterns: list[str], n: np.ndarray, rules: tuple[Rule, ...], prior: float = 0.8, rounds: int = 200) -> LabelModel:
    """EM over vote patterns with counts n; a few imagined votes (a thousandth) keep the sense of the start."""
    start = np.array([START] * len(rules))
    model = LabelModel(prior, start)
    if not patterns:
        return model
    v = np.array([[int(x) for x in p] for p in patterns])
    imagined = max(2.0, 0.001 * float(n.sum()))
    for _ in range(rounds):
        good = model.posterior(patterns)
        speaks = imagined * start
        for y, weight in ((0, (1 - good) * n), (1, good * n)):
            for r in range(len(rules)):
                speaks[r, y] += np.bincount(v[:, r], weight, 3)
        share = float((good * n).sum() + imagined * prior) / float(n.sum() + imagined)
        model = LabelModel(share, speaks / speaks.sum(2, keepdims=True))
    return model


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, least: float = 0.5) -> DataFrame:
    """(id, COUNTS..., votes string, base_failed boolean, quality double, kept boolean)."""
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = written(measured(docs, id_col, text_col)).withColumn("votes", votes(rules)).withColumn("base_failed", base)
    passed = F.count_if(~F.col("base_failed")).alias("n")  # the model is about texts that the base rule leaves
    seen = rows.groupBy("votes").agg(passed).orderBy("votes").collect()  # at most 3^rules rows
    patterns = [r.votes for r in seen]
    quality = learn(patterns, np.array([r.n for r in seen], float), rules).posterior(patterns)
    table = docs.sparkSession.createDataFrame(list(zip(patterns, quality.tolist(), strict=True)), "votes string, quality double")
    rows = rows.join(F.broadcast(table), "votes")  # bounded like the patterns
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base counts, and whether base rule and weakly supervised rules keep it."""
    found = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
