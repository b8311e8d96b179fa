"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of order 5 over lower-case letters, runs of anything else being one space.
Models are sorted arrays of n-gram hashes with log probabilities and back-off weights beside them. A
text belongs to the language with the lowest cross-entropy per character. It is rejected where even
that is higher than texts of the language are: a limit calibrated per language on documents that
did not train the models, with more room for short texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchload.llm.common import mix64, stored

ORDER = 5
#: Expected documents per language that train the models, and that calibrate them. The labelled
#: sample is bounded by these, not by the size of the table.
TRAIN_DOCS = 1_500
CALIBRATE_DOCS = 500
#: Characters expected in the sample of a language: of long documents fewer are in it.
SAMPLE_CHARS = 40_000_000
#: Texts longer than this are scored in pieces whose sums are added.
PIECE = 500_000
BLOCK = 1_000_000
#: The share of calibration documents of a language that its limit lets pass, and the room beyond.
KEPT = 0.999
ROOM = 0.75
SHORT_ROOM = 4.0

PAD = "\x01"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(int(_BASE), k, 2**64) for k in range(ORDER + 1)], np.uint64)


_TABLE: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter; made once per process."""
    if not _TABLE:
        _TABLE.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _TABLE[0]


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, start) of lower-cased texts, one after the other, each behind ORDER - 1 pads.

    Letters stay; every run of other characters is one space.
    """
    padded = [PAD * (ORDER - 1) + text.lower() for text in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(text) for text in padded], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    letter = letters()[codes]
    pad = np.zeros(len(codes), bool)
    for k in range(ORDER - 1):
        pad[starts + k] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] | pad[:-1]
    keep |= pad
    codes = np.where(letter | pad, codes, np.uint32(32))
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], kept_before[starts]


def hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of the last ORDER codes at every place; before an array's start stands nothing."""
    wide = codes.astype(np.uint64)
    wide += np.uint64(1)
    total = wide.copy()
    for k in range(1, ORDER):
        total[k:] += wide[:-k] * _POWERS[k]
    return total


@dataclass
class Model:
    """One language: per order, sorted hashes of n-grams and of contexts with their logarithms."""

    grams: list[np.ndarray] = field(default_factory=list)
    log_p: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    log_back: list[np.ndarray] = field(default_factory=list)
    unseen: float = 0.0

    def score(self, windows: np.ndarray) -> np.ndarray:
        """Log probability of the last code of each window, given those before it."""
        by_order = [mix64(h[:, -1]) for h in _window_hashes(windows)]
        before = [mix64(h[:, -1]) for h in _window_hashes(windows[:, :-1])]
        total = np.zeros(len(windows))
        open_ = np.arange(len(windows))
        for order in range(ORDER, 0, -1):
            at, hit = _find(self.grams[order - 1], by_order[order - 1][open_])
            total[open_[hit]] += self.log_p[order - 1][at[hit]]
            open_ = open_[~hit]
            if order > 1 and len(open_):
                at, hit = _find(self.contexts[order - 1], before[order - 2][open_])
                total[open_[hit]] += self.log_back[order - 1][at[hit]]
        total[open_] += self.unseen
        return total


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


def _window_hashes(windows: np.ndarray) -> list[np.ndarray]:
    """Per length, the hash of the last codes of every window, as a column."""
    wide = windows.astype(np.uint64) + np.uint64(1)
    out, total = [], np.zeros((len(windows), 1), np.uint64)
    for k in range(windows.shape[1]):
        total = total + (wide[:, -1 - k] * _POWERS[k])[:, None]
        out.append(total)
    return out


def fit(grams: pd.DataFrame) -> Model:
    """Interpolated Kneser-Ney from a language's counts of ORDER-grams (columns gram, n).

    The highest order counts occurrences, lower ones count the different characters to the left.
    Every order has its own discount, n1 / (n1 + 2 n2).
    """
    model = Model()
    counts = dict(zip(grams["gram"], grams["n"], strict=True))
    levels = [counts]
    for _ in range(ORDER - 1):
        levels.insert(0, Counter(gram[1:] for gram in levels[0]))
    alphabet = len(levels[0]) + 1
    lower: dict[str, float] = {}
    model.unseen = -np.log(alphabet)
    for order, level in enumerate(levels, 1):
        ones = sum(1 for n in level.values() if n == 1)
        twos = sum(1 for n in level.values() if n == 2)
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        total: Counter = Counter()
        followers: Counter = Counter()
        for gram, n in level.items():
            total[gram[:-1]] += n
            followers[gram[:-1]] += 1
        p = {}
        for gram, n in level.items():
            context = gram[:-1]
            rest = lower[gram[1:]] if order > 1 else 1 / alphabet
            back = discount * followers[context] / total[context]
            p[gram] = (n - discount) / total[context] + back * rest
        if order == 1:  # an unseen character gets the mass that the discount frees
            model.unseen += np.log(discount * followers[""] / total[""])
        lower = p
        model_grams = _sorted_hashes(list(p), list(p.values()))
        backs = {h: discount * followers[h] / total[h] for h in total if order > 1}
        model_contexts = _sorted_hashes(list(backs), list(backs.values()))
        model.grams.append(model_grams[0])
        model.log_p.append(model_grams[1])
        model.contexts.append(model_contexts[0])
        model.log_back.append(model_contexts[1])
    return model


def _codes(grams) -> np.ndarray:
    """The code points of n-grams of one length, one row each."""
    flat = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(grams), -1)


def _sorted_hashes(keys: list[str], values: list[float]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0)
    found = mix64(_window_hashes(_codes(keys))[-1][:, 0])
    order = np.argsort(found)
    return found[order], np.log(np.array(values))[order]


@dataclass
class Identifier:
    """The models of all languages, in the order of their names, and what was calibrated."""

    langs: list[str]
    models: list[Model]
    limits: np.ndarray  # highest cross-entropy per language
    sharpness: float  # turns differences of cross-entropy into confidence
    known: np.ndarray | None = None  # hashes of n-grams that any language has seen, sorted
    scores: np.ndarray | None = None  # their log probabilities, one column per language

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sums, n): per text and language the sum of -log p, and the characters counted.

        Texts without a letter count 0. Without languages, texts with one count 1.
        """
        if not self.langs:
            letter = [any(map(str.isalpha, text)) for text in texts]
            return np.zeros((len(texts), 0)), np.array(letter, np.int64)
        pieces, owner = [], []
        for i, text in enumerate(texts):
            for at in range(0, len(text), PIECE):
                pieces.append(text[at : at + PIECE])
                owner.append(i)
        sums, n = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        block, first, size = [], 0, 0
        for i, piece in enumerate(pieces):
            block.append(piece)
            size += len(piece)
            if size >= BLOCK or i == len(pieces) - 1:
                part, count = self._block(block)
                np.add.at(sums, owner[first : i + 1], part)
                np.add.at(n, owner[first : i + 1], count)
                block, first, size = [], i + 1, 0
        return sums, n

    def _block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes, starts = normalised(texts)
        found = hashes(codes)
        scored = np.ones(len(codes), bool)
        for k in range(ORDER - 1):
            scored[starts + k] = False
        labels, distinct = pd.factorize(found)
        first = np.empty(len(distinct), np.int64)
        first[labels[::-1]] = np.arange(len(labels) - 1, -1, -1)
        at, hit = _find(self.known, mix64(distinct))
        table = np.empty((len(distinct), len(self.langs)), np.float32)
        table[hit] = self.scores[at[hit]]
        rare = first[~hit]
        rare_ok = rare >= ORDER - 1
        windows = np.zeros((len(rare), ORDER), np.uint32)
        for k in range(ORDER):
            windows[rare_ok, ORDER - 1 - k] = codes[rare[rare_ok] - k]
        for column, model in enumerate(self.models):
            table[~hit, column] = model.score(windows)
        lengths = np.diff(np.append(starts, len(codes))) - (ORDER - 1)
        sums = np.empty((len(texts), len(self.langs)))
        for column in range(len(self.langs)):
            values = np.where(scored, table[:, column][labels], np.float32(0)).astype(np.float64)
            sums[:, column] = -np.add.reduceat(values, starts)
        has_letter = np.add.reduceat((scored & (codes != 32)).astype(np.int64), starts) > 0
        return np.where(has_letter[:, None], sums, 0.0), np.where(has_letter, lengths, 0)

    def identify(self, texts: list[str | None]) -> pd.DataFrame:
        """lang, score, rejected, entropy for every text.

        `lang` is the nearest language even where `rejected` is true, or null where the text is
        null or has no letter. Ties go to the first language by name. Without languages `lang` is
        null, and only texts without a letter are rejected.
        """
        sums, n = self.entropies([text or "" for text in texts])
        mean = sums / np.maximum(n, 1)[:, None]
        none = n == 0
        if not self.langs:
            return pd.DataFrame({"lang": None, "score": 0.0, "rejected": none, "entropy": 0.0})
        nearest, lowest = mean.argmin(axis=1), mean.min(axis=1)
        apart = np.exp(-self.sharpness * np.sqrt(n)[:, None] * (mean - lowest[:, None]))
        score = 1 / apart.sum(axis=1)
        limit = self.limits[nearest] + SHORT_ROOM / np.sqrt(np.maximum(n, 1))
        return pd.DataFrame(
            {
                "lang": [None if x else self.langs[k] for x, k in zip(none, nearest, strict=True)],
                "score": np.where(none, 0.0, score),
                "rejected": none | (lowest > limit),
                "entropy": np.where(none, 0.0, lowest),
            }
        )


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Identifier:
    """An identifier from the texts and non-null languages of `docs`.

    TRAIN_DOCS documents per language are expected in the sample that trains, CALIBRATE_DOCS others
    in the one that calibrates, fewer where documents are so long that the sample of a language
    would have more than SAMPLE_CHARS characters. Both are chosen by a hash of id and text, not by
    length. Every language has a document that trains. n-grams are counted on the executors; the
    driver gets the counts of the sample. Without any labelled text there are no languages.
    """
    labelled = docs.select(
        F.pmod(F.xxhash64(F.col(id_col).cast("string"), text_col), F.lit(2**30)).alias("h"),
        F.col(text_col).alias("text"),
        F.col(lang_col).alias("lang"),
    ).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    found = labelled.groupBy("lang").agg(
        F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.min("h").alias("first")
    )
    per_lang = {r["lang"]: r for r in found.collect()}
    if not per_lang:
        return Identifier([], [], np.zeros(0), 1.0)
    wanted = TRAIN_DOCS + CALIBRATE_DOCS
    upper, split, first = F.lit(None), F.lit(None), F.lit(None)
    for lang, r in per_lang.items():
        ours = F.col("lang") == F.lit(lang)
        share = min(1.0, wanted / r["n"], SAMPLE_CHARS / r["chars"])
        first = F.when(ours, r["first"]).otherwise(first)
        upper = F.when(ours, int(share * 2**30)).otherwise(upper)
        split = F.when(ours, int(share * 2**30 * TRAIN_DOCS / wanted)).otherwise(split)
    is_first = F.col("h") == first
    sample = labelled.where((F.col("h") < upper) | is_first).select(
        "text", "lang", ((F.col("h") < split) | is_first).alias("trains")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                counts: Counter = Counter()
                for text in part["text"]:
                    codes, _ = normalised([text])
                    line = codes.tobytes().decode("utf-32-le", "surrogatepass")
                    counts.update(line[i : i + ORDER] for i in range(len(line) - ORDER + 1))
                yield pd.DataFrame(
                    {"lang": lang, "gram": list(counts), "n": list(counts.values())}
                )

    grams = stored(
        sample.where("trains").select("lang", "text")
        .mapInPandas(count, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    # One language after the other: the driver holds the counts of one at a time.
    langs, models, seen = [], [], []
    for lang in sorted(per_lang):
        counts_of = grams.where(F.col("lang") == lang).select("gram", "n").toPandas()
        if len(counts_of):
            langs.append(lang)
            models.append(fit(counts_of))
            seen.append(_codes(counts_of["gram"]))
    if not langs:
        return Identifier([], [], np.zeros(0), 1.0)
    codes = np.concatenate(seen)
    known, first = np.unique(mix64(_window_hashes(codes)[-1][:, 0]), return_index=True)
    scores = [model.score(codes[first]).astype(np.float32) for model in models]
    limits = np.full(len(langs), np.inf)
    found = Identifier(langs, models, limits, 1.0, known, np.stack(scores, axis=1))
    return _calibrated(found, sample.where("NOT trains"))


def _calibrated(found: Identifier, sample: DataFrame) -> Identifier:
    """`found` with limits and sharpness from documents that did not train it."""
    shared = sample.sparkSession.sparkContext.broadcast(found)
    langs = found.langs

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums, n = shared.value.entropies(list(batch["text"]))
            yield pd.DataFrame({"lang": batch["lang"].values, "n": n, "sums": list(sums)})

    rows = sample.select("text", "lang").mapInPandas(
        measure, "lang string, n long, sums array<double>"
    ).toPandas()
    shared.destroy()
    rows = rows[(rows["n"] > 0) & rows["lang"].isin(langs)]
    if rows.empty:
        return found
    mean = np.stack(rows["sums"]) / rows["n"].values[:, None]
    own = rows["lang"].map({lang: k for k, lang in enumerate(langs)}).values
    entropy = mean[np.arange(len(own)), own] - SHORT_ROOM / np.sqrt(rows["n"].values)
    overall = np.quantile(entropy, KEPT)
    for k in range(len(langs)):
        mine = entropy[own == k]
        limit = np.quantile(mine, KEPT) if len(mine) else overall
        # Few documents say little: their language has the limit of all, or more if they need it.
        found.limits[k] = (limit if len(mine) >= 50 else max(limit, overall)) + ROOM
    root = np.sqrt(rows["n"].values)[:, None]
    losses = []
    for sharpness in (grid := np.geomspace(0.1, 10, 21)):
        logits = -sharpness * root * mean
        logits -= logits.max(axis=1, keepdims=True)
        losses.append(np.mean(np.log(np.exp(logits).sum(axis=1)) - logits[np.arange(len(own)), own]))
    found.sharpness = float(grid[int(np.argmin(losses))])
    return found


RESULT = "struct<lang:string,score:double,rejected:boolean,entropy:double>"


def identify(text: Column, found: Identifier, spark) -> Column:
    """A struct of lang, score, rejected and entropy for whole texts; see `Identifier.identify`."""
    shared = spark.sparkContext.broadcast(found)

    @F.pandas_udf(RESULT)
    def identified(texts: pd.Series) -> pd.DataFrame:
        return shared.value.identify(list(texts))

    # A filter on the result must not be computed by a second pass over the texts.
    return identified.asNondeterministic()(text)
