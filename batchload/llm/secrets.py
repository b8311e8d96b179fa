"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio.

Three fixed kinds of secret are found by pattern. Beyond them, every long run of key characters is
scored by two first-order Markov models over characters, one of random strings and one of ordinary
identifiers; a run becomes a span of kind `random` where its log-likelihood ratio per character is
above a threshold, and else its stretches of 16 characters and more do where theirs is. Both models
are counts of character pairs in labelled samples: values that the patterns find are random strings,
other runs of key characters are ordinary, and so, in equal parts, are identifiers put together from
common words in the ways that programs and paths do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, the least lengths and the order of the kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "random")

#: What the Markov models look at.
LEAST_RUN = 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SEPARATORS = "=/_-"
#: Ordinary identifiers for training may be shorter.
ORDINARY = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Pseudo-count of every pair of characters, and of all pairs of a character among identifiers.
SMOOTHING = 0.5
IDENTIFIER_SMOOTHING = 20
#: Words that labelled identifiers are made of; any words of the texts at hand will do.
IDENTIFIER_WORDS = (
    "access action adapter agent allocate api application argument article async audio author "
    "backup base binary body border branch buffer bundle byte callback category change char "
    "child client close code color command common config console container context convert "
    "core create custom database debug default delete depth detail dialog directory display "
    "domain download dynamic editor email enable engine entry environment event exception "
    "expression factory feature field filter first float font frame function generate graph "
    "handler header hidden home host http identifier implement index init input integer "
    "internal iterator json key label last layout level license line list loader location log "
    "login lower manager margin match max menu message method middle mobile mode module mouse "
    "native next notification number offset operation order output package panel parent "
    "partition path payload picture plugin policy popup position preview print private "
    "product project protocol proxy query quick range read redirect refresh register remote "
    "render report request reset response retry right root row runtime save schedule scope "
    "screen search security select sequence service setting shape shell simple size socket "
    "sort span split stage start static step store string style success summary switch sync "
    "table task terminal text threshold title token total track transfer tree"
).split()
#: So many documents are expected in the sample that the models are fitted to.
SAMPLE_DOCS = 20_000
#: The threshold may rise until this part of random strings of so many characters is below it.
MISSED = 0.02
KEY_CHARS = 20
#: A run needs this ratio per character (nats) at least, however well the samples separate.
LEAST_RATIO = 0.35

SPANS = "array<struct<kind:string,start:long,end:long,score:double>>"
_CODES = np.full(128, -1, np.int16)
_CODES[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratio, random over ordinary, of every pair of characters; the threshold."""

    ratio: np.ndarray
    threshold: float

    def score(self, run: str) -> float:
        """The ratio per pair of neighbours in `run`."""
        return float(self.ratios(run).mean())

    def ratios(self, run: str) -> np.ndarray:
        codes = _CODES[np.frombuffer(run.encode("ascii"), np.uint8)]
        return self.ratio[codes[:-1], codes[1:]]

    def best(self, run: str) -> float:
        """The highest score of any stretch of LEAST_RUN characters or more in `run`.

        A stretch of twice the least length is no better than the better of its halves.
        """
        sums = np.append(0.0, np.cumsum(self.ratios(run)))
        least = LEAST_RUN - 1
        widths = range(least, min(2 * least, len(sums)))
        return max(float((sums[w:] - sums[:-w]).max()) / w for w in widths)

    def stretches(self, run: str) -> list[tuple[int, int, float]]:
        """(start, end, score) of what is random in `run`: all of it, or stretches between separators.

        A stretch is where the pairs' ratios are above the threshold by the largest sum; it is widened
        to the separators around it, and what is left on both sides is looked at in turn.
        """
        score = self.score(run)
        if score > self.threshold:
            return [(0, len(run), score)]
        ratios, found, open_ = self.ratios(run), [], [(0, len(run))]
        while open_:
            low, high = open_.pop()
            if high - low < LEAST_RUN:
                continue
            sums = np.append(0.0, np.cumsum(ratios[low : high - 1] - self.threshold))
            least = LEAST_RUN - 1
            lowest = np.minimum.accumulate(sums[:-least])
            gains = sums[least:] - lowest
            last = int(gains.argmax())
            if gains[last] <= 1e-9:
                continue
            first = int(sums[: last + 1].argmin())
            start, end = low + first, low + last + least + 1
            score = float(ratios[start : end - 1].mean())
            start = max(low, *(run.rfind(c, low, start) + 1 for c in SEPARATORS))
            end = min([high, *(at for c in SEPARATORS if (at := run.find(c, end, high)) >= 0)])
            found.append((start, end, score))
            open_ += [(low, start), (end, high)]
        return sorted(found)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed kinds, leftmost and non-overlapping in each kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGNED:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found.extend((m.start(), 1, m.end()) for m in ACCESS.finditer(text))
    found.extend((m.start(), 2, m.end()) for m in HEX.finditer(text))
    return sorted(found)


def runs_outside(text: str, spans: list[tuple[int, int, int]], pattern) -> Iterator[re.Match]:
    """Matches of `pattern` that share no character with any span. `spans` is sorted by start."""
    at, reach = 0, 0
    for m in pattern.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= m.start():
            yield m


def outside(start: int, end: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of start..end, LEAST_RUN characters or more, outside `spans`, sorted by start."""
    for span_start, _, span_end in [*spans, (end, 0, end)]:
        if span_start - start >= LEAST_RUN:
            yield start, span_start
        start = max(start, span_end)


def spans_of(text: str, models: Models) -> list[tuple[int, int, int, float]]:
    """(start, kind number, end, score), sorted by start, then kind. Fixed kinds score 1."""
    base = base_spans(text)
    found = [(*span, 1.0) for span in base]
    at, reaching = 0, []
    for m in RUN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reaching.append(base[at])
            at += 1
        reaching = [span for span in reaching if span[2] > m.start()]
        for start, end in outside(m.start(), m.end(), reaching):
            for low, high, score in models.stretches(text[start:end]):
                found.append((start + low, 3, start + high, score))
    return sorted(found)


def identifiers(words: list[str]) -> list[str]:
    """Labelled identifiers: every word with two others, in all the styles."""
    out = []
    for k, word in enumerate(words):
        for style in range(12):
            others = words[(7 * k + 3 * style + 1) % len(words)], words[(13 * k + 5 * style + 2) % len(words)]
            out.append(_styled([word, *others], style, (31 * k + 7 * style) % 1000))
    return out


def _styled(low: list[str], style: int, number: int) -> str:
    cap = [word.capitalize() for word in low]
    return (
        low[0] + "".join(cap[1:]),
        "".join(cap),
        "_".join(low),
        "-".join(low),
        "/" + "/".join(low),
        "_".join(low).upper(),
        f"{low[0]}{number}_{low[1]}_{low[2]}",
        f"{cap[0]}{number}{cap[1]}{low[2].upper()}",
        "/".join([low[0], *cap[1:]]),
        low[0].upper() + "".join(cap[1:]),
        f"{cap[0]}{cap[1]}{low[2][:3].upper()}{number % 10}",
        "_".join(cap),
    )[style]


def pair_counts(runs: list[str]) -> np.ndarray:
    """How often each character of the alphabet follows each other one."""
    counts = np.zeros((len(ALPHABET), len(ALPHABET)))
    for run in runs:
        codes = _CODES[np.frombuffer(run.encode("ascii", "ignore"), np.uint8)]
        ok = (codes[:-1] >= 0) & (codes[1:] >= 0)
        np.add.at(counts, (codes[:-1][ok], codes[1:][ok]), 1)
    return counts


def labelled_runs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(random, run): the distinct labelled runs of a sample of the documents.

    The sample is chosen by a hash of id and text, so that about SAMPLE_DOCS rows are expected in it
    at any size of the table.
    """
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_col), F.lit(1_000_000)) < share * 1e6
    sample = docs.where(chosen & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = set()
            for text in batch["text"]:
                base = base_spans(text)
                for start, kind, end in base:
                    value = text[start:end]
                    found.add((True, ASSIGN.fullmatch(value)[2] if kind == 0 else value))
                found.update((False, m[0]) for m in runs_outside(text, base, ORDINARY))
            yield pd.DataFrame(list(found), columns=["random", "run"])

    return sample.mapInPandas(label, "random boolean, run string").distinct()


def score_counts(docs: DataFrame, text_col: str, models: Models) -> list[tuple[int, int]]:
    """(score, n): how many distinct long runs of all documents that no pattern finds have a best
    stretch of each score, in tenths."""
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = {
                (xxhash.xxh64_intdigest(m[0]) >> 1, math.ceil(10 * models.best(m[0])))
                for text in batch["text"]
                for m in runs_outside(text, base_spans(text), RUN)
            }
            yield pd.DataFrame(list(found), columns=["run", "score"])

    each = texts.mapInPandas(scores, "run long, score long").distinct()
    counts = each.groupBy("score").agg(F.count("*").alias("n")).collect()
    return [(row["score"], row["n"]) for row in counts]


def highest_threshold(ratio: np.ndarray) -> float:
    """The threshold by which MISSED of random strings of KEY_CHARS letters and digits are missed."""
    codes = np.random.default_rng(0).integers(0, 62, (2_000, KEY_CHARS))
    scores = ratio[codes[:, :-1], codes[:, 1:]].mean(axis=1)
    return float(np.quantile(scores, MISSED))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Models:
    """Both models from the labelled sample of `docs`, the threshold from all documents.

    Pairs are counted on the executors; the driver gets one count per label and pair, and one count
    per label and score of a tenth of a nat. The threshold is LEAST_RATIO, or the lowest score above
    which at most one ordinary run in ten thousand lies, if that is higher: but no higher than where
    MISSED of random strings would be missed, as what is taken for ordinary may hold secrets that no
    pattern knows. Without labelled random strings every score is zero, and no run is above the
    threshold.
    """
    runs = labelled_runs(docs, id_col, text_col)

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((2, len(ALPHABET) ** 2), np.int64)
        for batch in batches:
            for label in (0, 1):
                counts[label] += pair_counts(list(batch["run"][batch["random"] == bool(label)])).ravel().astype(np.int64)
        random, pair = np.nonzero(counts)
        yield pd.DataFrame({"random": random == 1, "pair": pair, "n": counts[random, pair]})

    counts = np.zeros((2, len(ALPHABET) ** 2))
    summed = runs.mapInPandas(pairs, "random boolean, pair long, n long").groupBy("random", "pair")
    for row in summed.agg(F.sum("n").alias("n")).collect():
        counts[int(row["random"]), row["pair"]] += row["n"]
    if not counts[1].any():
        return Models(np.zeros((len(ALPHABET), len(ALPHABET))), LEAST_RATIO)
    chains = counts.reshape(2, len(ALPHABET), len(ALPHABET)) + SMOOTHING
    chains /= chains.sum(axis=2, keepdims=True)
    made = pair_counts(identifiers(IDENTIFIER_WORDS))
    alone = (made.sum(axis=0) + 1) / (made.sum() + len(ALPHABET))
    made = (made + IDENTIFIER_SMOOTHING * alone) / (made.sum(axis=1, keepdims=True) + IDENTIFIER_SMOOTHING)
    ratio = np.log(chains[1]) - np.log((chains[0] + made) / 2)
    # Words joined by separators are rare among ordinary runs: a separator is no sign of a secret.
    joins = [ALPHABET.index(c) for c in SEPARATORS]
    ratio[joins, :] = np.minimum(ratio[joins, :], 0)
    ratio[:, joins] = np.minimum(ratio[:, joins], 0)

    found = sorted(score_counts(docs, text_col, Models(ratio, 0.0)), reverse=True)
    allowed, threshold = sum(n for _, n in found) // 10_000, LEAST_RATIO
    for score, n in found:
        allowed -= n
        if allowed < 0:
            threshold = max(LEAST_RATIO, min(score / 10, highest_threshold(ratio)))
            break
    return Models(ratio, threshold)


def find(text: Column, models: Models) -> Column:
    """The spans of a text column: kind, start and end in code points, score.

    Whole texts are read. A null or empty text has no spans. Fixed kinds may overlap each other;
    spans of kind `random` overlap nothing.
    """

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {"kind": KINDS[kind], "start": start, "end": end, "score": score}
                    for start, kind, end, score in (spans_of(text, models) if text else ())
                ]
                for text in texts
            ]
        )

    return spans(text)


def redact(text: Column, models: Models, mark: str = "[SECRET]") -> Column:
    """The text with every stretch of overlapping spans replaced by `mark`; null stays null."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        out = []
        for value in texts:
            spans = spans_of(value, models) if value else ()
            if not spans:
                out.append(value)
                continue
            parts, done = [], 0
            for start, _, end, _ in spans:
                if start >= done:
                    parts += [value[done:start], mark]
                done = max(done, end)
            parts.append(value[done:])
            out.append("".join(parts))
        return pd.Series(out, dtype=object)

    return cleaned(text)


def scan(
    docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, spans) for every row, repeated rows included; other columns play no part."""
    return docs.select(F.col(id_col).alias("doc_id"), find(F.col(text_col), models).alias("spans"))
