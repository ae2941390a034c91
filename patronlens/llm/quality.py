"""Quality rules with line labels from a linear-chain conditional random field.

Fixed rules reject very short and very repetitive texts. In the others the field labels every line
as content or boilerplate by Viterbi decoding, and a text stays if content has its share of the words.
The field is fitted on labelled texts (a line takes its text's label): a bounded sample, chosen by
hash of the id, of `SAMPLE` texts per label with at most `SAMPLE_CHARS` characters. Everything else
covers all texts in whole.

Defined cases: a null text is empty; a text without words fails the base rules; lines without
words carry no label; without labelled texts of both kinds every line is content; several labels
of one id count as the smallest; repeated rows get equal results; an empty table gives an empty
result. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 600
SAMPLE_CHARS = 20_000
SEED = 9
SHARE = 0.5

# The base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"

_SPACE = " \t\n\x0b\x0c\r"
_BLANKS = {ord(c): " " for c in _SPACE}
_ODD = frozenset(SYMBOLS + "!~=_+^\\/{}[]@")
FEATURES = ("bias", "odd_words", "upper_words", "repeated", "symbols", "seen_before", "short", "open_end", "digits")
VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, content_share double, n_lines long, n_content_lines long"
)


def words_of(text: str) -> list[str]:
    """Runs without space and 0x09-0x0D; str.split() would cut at further characters."""
    return [w for w in text.translate(_BLANKS).split(" ") if w]


def _repeat_words(words: list[str]) -> int:
    """Words covered by a 3-word window that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    last = dict(zip(words, range(n)))
    ids = np.fromiter(map(last.__getitem__, words), np.int64, n)
    _, pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
    _, where, counts = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    often = counts[where] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift:n - 2 + shift] |= often
    return int(covered.sum())


def line_features(line: str, words: list[str], seen: bool) -> list[float]:
    n = len(words)
    symbols = sum(map(line.count, SYMBOLS))
    return [
        1.0,
        sum(w[-1] in _ODD for w in words) / n,
        sum(map(str.isupper, words)) / n,
        1.0 - len(set(words)) / n,
        min(1.0, 5.0 * symbols / len(line)),
        float(seen),
        float(n < 5),
        float(line.rstrip()[-1:] not in ".!?:"),
        sum(map(str.isdigit, words)) / n,
    ]


@dataclass(frozen=True)
class LineField:
    """Log-linear scores: of each label given a line's features, and of each label after another."""

    emission: np.ndarray  # features x 2, label 1 is content
    transition: np.ndarray  # 2 x 2, from and to

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The best label sequence; ties go to content."""
        scores = (features @ self.emission).tolist()
        (t00, t01), (t10, t11) = self.transition.tolist()
        b, c = scores[0]
        back: list[tuple[int, int]] = []
        for eb, ec in scores[1:]:
            to_b = (1, c + t10) if c + t10 >= b + t00 else (0, b + t00)
            to_c = (1, c + t11) if c + t11 >= b + t01 else (0, b + t01)
            back.append((to_b[0], to_c[0]))
            b, c = to_b[1] + eb, to_c[1] + ec
        label = int(c >= b)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return np.array(labels[::-1])


def _lines(text: str) -> tuple[np.ndarray, list[int], int]:
    """Features and word counts of the lines that have words, and how many of them equal an earlier one."""
    rows, sizes, seen, repeats = [], [], set(), 0
    for line in text.split("\n"):
        words = words_of(line)
        if not words:
            continue
        again = line in seen
        repeats += again
        seen.add(line)
        rows.append(line_features(line, words, again))
        sizes.append(len(words))
    return np.array(rows).reshape(-1, len(FEATURES)), sizes, repeats


def fit_field(texts: list[tuple[str, int]], rounds: int = 150, rate: float = 0.3, penalty: float = 1e-3) -> LineField:
    """Penalised likelihood of the labels given the lines, by gradient steps over padded sequences."""
    chains = [(f, y) for text, y in texts for f, sizes, _ in [_lines(text)] if sizes]
    if len({y for _, y in chains}) < 2:
        neutral = np.zeros((len(FEATURES), 2))
        neutral[0, 1] = 1.0
        return LineField(neutral, np.zeros((2, 2)))
    steps = min(64, max(len(f) for f, _ in chains))
    pieces = [(f[i:i + steps], y) for f, y in chains for i in range(0, len(f), steps)]
    x = np.zeros((len(pieces), steps, len(FEATURES)))
    held = np.zeros((len(pieces), steps), bool)
    y = np.array([label for _, label in pieces])
    for i, (f, _) in enumerate(pieces):
        x[i, : len(f)] = f
        held[i, : len(f)] = True
    balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    balance = balance / held.sum(axis=1)
    w, t = np.zeros((len(FEATURES), 2)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    truth = np.eye(2)[y]
    for turn in range(1, rounds + 1):
        e = x @ w
        e[~held] = 0.0
        up, down = np.zeros_like(e), np.zeros_like(e)
        up[:, 0] = e[:, 0]
        for k in range(1, steps):
            moved = np.logaddexp.reduce(up[:, k - 1, :, None] + t, axis=1) + e[:, k]
            up[:, k] = np.where(held[:, k, None], moved, up[:, k - 1])
        for k in range(steps - 2, -1, -1):
            moved = np.logaddexp.reduce(t + (e[:, k + 1] + down[:, k + 1])[:, None, :], axis=2)
            down[:, k] = np.where(held[:, k + 1, None], moved, down[:, k + 1])
        total = np.logaddexp.reduce(up[:, -1], axis=1)
        single = np.exp(up + down - total[:, None, None]) * held[..., None]
        gw = np.einsum("nkf,nkc,n->fc", x, truth[:, None, :] * held[..., None] - single, balance) - penalty * w
        gt = -penalty * t
        for k in range(1, steps):
            both = np.exp(up[:, k - 1, :, None] + t + (e[:, k] + down[:, k])[:, None, :] - total[:, None, None])
            diff = (truth[:, :, None] * truth[:, None, :] - both) * held[:, k, None, None]
            gt = gt + np.einsum("nab,n->ab", diff, balance)
        for g, i in ((gw, 0), (gt, 2)):
            moments[i] = 0.9 * moments[i] + 0.1 * g
            moments[i + 1] = 0.999 * moments[i + 1] + 0.001 * g * g
        ahead = [m / (1 - 0.9**turn) for m in (moments[0], moments[2])]
        size = [np.sqrt(m / (1 - 0.999**turn)) + 1e-8 for m in (moments[1], moments[3])]
        w, t = w + rate * ahead[0] / size[0], t + rate * ahead[1] / size[1]
    return LineField(w, t)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE, most_chars: int = SAMPLE_CHARS,
) -> list[tuple[str, int]]:
    """At most `sample` texts per label, smallest hash of the id first; in order of id."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_label"))
    ids = [
        known.where(F.col("_label") == value).orderBy(F.xxhash64("_key", F.lit(SEED)), "_key").limit(sample)
        for value in (0, 1)
    ]
    # At most two samples of ids, whatever the size of the tables.
    few = F.broadcast(ids[0].unionByName(ids[1]))
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(F.length("_text").between(1, most_chars))
    rows = texts.join(few, "_key").groupBy("_key", "_label").agg(F.min("_text").alias("_text")).limit(2 * sample)
    return [(r["_text"], r["_label"]) for r in sorted(rows.collect(), key=lambda r: r["_key"])]


def judge(text: str | None, field: LineField, share: float = SHARE) -> tuple:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, _SPACE))
    features, sizes, repeats = _lines(text)
    repeat_words = _repeat_words(words)
    failed = n < LEAST_WORDS or 100 * repeat_words > MOST_REPEATED * n
    content, part = 0, 0.0
    if sizes:
        labels = field.viterbi(features)
        content = int(labels.sum())
        part = float(np.dot(labels, sizes)) / n
    symbols = sum(map(text.count, SYMBOLS))
    return n, word_chars, symbols, repeats, repeat_words, failed, not failed and part >= share, part, len(sizes), content


def verdict_column(text: Column, field: LineField, share: float = SHARE) -> Column:
    names = [c.split()[0] for c in VERDICT.split(", ")]

    @F.pandas_udf(VERDICT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([judge(t, field, share) for t in batch], columns=names)

    return of(text)


def quality_verdicts(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per document: key and the columns of `VERDICT`."""
    field = fit_field(labelled_sample(docs, labels, key, text, label))
    return docs.select(F.col(key).alias(key), verdict_column(F.col(text), field).alias("_v")).select(key, "_v.*")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """The documents that the rules keep, with their columns."""
    field = fit_field(labelled_sample(docs, labels, key, text, label))
    return docs.where(verdict_column(F.col(text), field)["kept"])
