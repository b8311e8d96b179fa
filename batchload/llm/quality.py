"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line is described by measures of itself and of the lines beside it; the
chain adds how likely neighbours are to differ. Forward-backward gives the probability that a line is
good, and the mean over the lines, weighted by their length, is the quality of the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchload.llm.langid import letters

#: Labelled documents expected in the sample that trains, and lines of them.
TRAIN_DOCS = 8_000
TRAIN_LINES = 200_000
#: Lines of one chain in training: documents of more are cut into several.
STRETCH = 200
STEPS = 300
PENALTY = 1e-4
#: Texts are measured in blocks of about so many characters.
BLOCK = 2_000_000

MEASURES = (
    "bias", "length", "words", "word_length", "symbols", "upper", "digits", "distinct", "repeated",
    "bare", "ending", "short_words", "brief", "tail",
)
WIDTH = 3 * len(MEASURES) + 2

_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """1 letter, 2 upper-case letter, 4 digit, 8 white space, 0 anything else, by code point."""
    if not _CLASSES:
        kinds = letters().astype(np.uint8)
        for c in range(0x110000):
            char = chr(c)
            if kinds[c]:
                kinds[c] |= 2 * char.isupper()
            elif char.isdigit():
                kinds[c] = 4
            elif char.isspace():
                kinds[c] = 8
        _CLASSES.append(kinds)
    return _CLASSES[0]


def measures(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(rows, lengths): one row of MEASURES per line of the text, and its characters.

    An empty text is one empty line.
    """
    lines = text.split("\n")
    n = len(lines)
    kinds = classes()[np.frombuffer(f"{text}\n".encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.fromiter(map(len, lines), np.int64, n)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask.astype(np.int32), starts).astype(np.float64)

    letter, upper, digit = per_line(kinds & 1), per_line((kinds & 2) > 0), per_line(kinds == 4)
    space = per_line(kinds == 8) - 1
    ink = np.maximum(lengths - space, 1)
    words = np.empty((n, 6))
    for k, line in enumerate(lines):
        parts = line.split()
        count = len(parts)
        if not count:
            words[k] = 0
            continue
        words[k] = (
            count,
            len(set(parts)),
            sum(map(eq, parts, parts[1:])),
            sum(1 for part in parts if not part[0].isalnum() and not part[-1].isalnum()),
            sum(1 for part in parts if part[-1] in "$%&*#@!|+=~^<>_"),
            sum(1 for part in parts if len(part) <= 3),
        )
    count = np.maximum(words[:, 0], 1)
    last = np.fromiter((line.rstrip()[-1:] in (".", "?", "!", ":", '"') for line in lines), bool, n)
    rows = np.column_stack(
        [
            np.ones(n),
            np.log1p(lengths) / 5,
            np.minimum(words[:, 0] / 50, 3),
            np.minimum(ink / count / 10, 4),
            np.maximum(ink - letter - digit, 0) / ink,
            upper / np.maximum(letter, 1),
            digit / ink,
            words[:, 1] / count,
            words[:, 2] / count,
            words[:, 3] / count,
            last,
            words[:, 5] / count,
            lengths < 20,
            words[:, 4] / count,
        ]
    )
    return rows.astype(np.float32), lengths


def with_neighbours(rows: np.ndarray) -> np.ndarray:
    """Rows with those of the line before and behind beside them, and whether there is one."""
    n, k = rows.shape
    out = np.zeros((n, WIDTH), np.float32)
    out[:, :k] = rows
    out[1:, k : 2 * k] = rows[:-1]
    out[:-1, 2 * k : 3 * k] = rows[1:]
    out[0, 3 * k] = 1
    out[-1, 3 * k + 1] = 1
    return out


@dataclass
class Chain:
    """Weights of the state good over bad, scores of the transitions, and what centres a row."""

    weights: np.ndarray  # WIDTH
    moves: np.ndarray  # 2 x 2, from and to, of bad (0) and good (1)
    centre: np.ndarray
    scale: np.ndarray

    def marginals(self, rows: np.ndarray) -> np.ndarray:
        """The probability that each line is good."""
        emit = ((rows - self.centre) / self.scale) @ self.weights
        _, good, _ = forward_backward(emit[None, :], np.array([len(emit)]), self.moves)
        return good[0]

    def score(self, text: str | None) -> float:
        """The quality of a text, 0 to 1. A null text counts as empty."""
        rows, lengths = measures(text or "")
        weight = lengths + 1e-6
        return float(self.marginals(with_neighbours(rows)) @ weight / weight.sum())


def forward_backward(emit: np.ndarray, n: np.ndarray, moves: np.ndarray):
    """(log Z, marginals of good, expected transitions) of padded chains.

    emit is the score of good over bad, one row per chain of n lines.
    """
    chains, most = emit.shape
    alpha = np.zeros((most, chains, 2))
    beta = np.zeros((most, chains, 2))
    score = np.zeros((most, chains, 2))
    score[:, :, 1] = emit.T
    alive = np.arange(most)[:, None] < n[None, :]
    alpha[0] = score[0]
    for t in range(1, most):
        step = np.logaddexp(
            alpha[t - 1, :, :1] + moves[0], alpha[t - 1, :, 1:] + moves[1]
        ) + score[t]
        alpha[t] = np.where(alive[t][:, None], step, alpha[t - 1])
    for t in range(most - 2, -1, -1):
        onward = score[t + 1] + beta[t + 1]
        step = np.logaddexp(onward[:, :1] + moves[:, 0], onward[:, 1:] + moves[:, 1])
        beta[t] = np.where(alive[t + 1][:, None], step, 0.0)
    log_z = np.logaddexp(alpha[-1, :, 0], alpha[-1, :, 1])
    joint = alpha + beta
    good = np.exp(np.minimum(joint[:, :, 1] - np.logaddexp(joint[:, :, 0], joint[:, :, 1]), 0))
    pairs = np.zeros((2, 2))
    if most > 1:
        onward = score[1:] + beta[1:]
        for a in range(2):
            for b in range(2):
                p = np.exp(np.minimum(alpha[:-1, :, a] + moves[a, b] + onward[:, :, b] - log_z, 0))
                pairs[a, b] = p[alive[1:]].sum()
    return log_z, (good * alive).T, pairs


def fit(chains: list[np.ndarray], labels: np.ndarray) -> Chain:
    """Weights that make the labelled chains likely: every line of a document has its label.

    Full gradients with Adam steps. Chains of similar length share a padded block.
    """
    stacked = np.concatenate(chains).astype(np.float64)
    centre, scale = stacked.mean(axis=0), stacked.std(axis=0)
    centre[scale < 1e-9], scale[scale < 1e-9] = 0.0, 1.0
    order = np.argsort([len(chain) for chain in chains], kind="stable")
    blocks = []
    for at in range(0, len(order), 512):
        part = order[at : at + 512]
        n = np.array([len(chains[k]) for k in part])
        padded = np.zeros((len(part), n.max(), WIDTH))
        for row, k in enumerate(part):
            padded[row, : n[row]] = (chains[k] - centre) / scale
        blocks.append((padded, n, labels[part].astype(float)))
    total = len(stacked)
    state = np.zeros(WIDTH + 4)
    first, second = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, STEPS + 1):
        gradient = np.zeros_like(state)
        weights, moves = state[:WIDTH], state[WIDTH:].reshape(2, 2)
        for padded, n, label in blocks:
            alive = np.arange(padded.shape[1])[None, :] < n[:, None]
            _, good, pairs = forward_backward(padded @ weights, n, moves)
            gradient[:WIDTH] += np.einsum("ct,ctk->k", (label[:, None] - good) * alive, padded)
            held = np.zeros((2, 2))
            np.add.at(held, (label.astype(int), label.astype(int)), n - 1.0)
            gradient[WIDTH:] += (held - pairs).ravel()
        gradient = gradient / total - PENALTY * state
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        state = state + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Chain(state[:WIDTH], state[WIDTH:].reshape(2, 2), centre, scale)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_id_col: str = "doc_id", label_col: str = "quality",
) -> Chain:
    """A chain from `docs` and the labels 0 and 1 of some of them.

    About TRAIN_DOCS labelled rows are in the sample, chosen by a hash of the id, whatever the length
    of their texts. Their lines train in stretches of STRETCH that cover the whole text; where the
    sample has more than TRAIN_LINES lines, stretches are chosen by a hash too, so that about so
    many lines train. Null labels play no part; rows that repeat an id or a label count as often as
    they are there. Without labels, or on an empty table, every line is as likely good as bad.
    """
    known = labels.select(
        F.col(label_id_col).alias("id"), F.col(label_col).cast("double").alias("label")
    ).where("label IN (0, 1) AND id IS NOT NULL")
    share = min(1.0, TRAIN_DOCS / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(9)), F.lit(10**6)) < share * 1e6)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(known), "id")
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    total = sample.agg(F.sum(n_lines)).first()[0] or 0
    least = (1 - min(1.0, TRAIN_LINES / max(1, total))) * 2**32

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, label, text in zip(batch["id"].astype(str), batch["label"], batch["text"]):
                rows = with_neighbours(measures(text)[0])
                for at in range(0, len(rows), STRETCH):
                    if crc32(f"{key}:{at}".encode()) >= least:
                        out.append((key, label, at, rows[at : at + STRETCH].tobytes()))
            yield pd.DataFrame(out, columns=["id", "label", "at", "rows"])

    held = sample.mapInPandas(measured, "id string, label double, at long, rows binary")
    held = held.toPandas().sort_values(["id", "label", "at", "rows"])
    if held.empty:
        return Chain(np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(WIDTH), np.ones(WIDTH))
    chains = [np.frombuffer(rows, np.float32).reshape(-1, WIDTH) for rows in held["rows"]]
    return fit(chains, held["label"].to_numpy())


def score(text: Column, chain: Chain) -> Column:
    """The quality of whole texts, 0 to 1; null and empty texts count as one empty line. Equal texts
    have equal scores; an empty table has none."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([chain.score(text) for text in texts], dtype=float)

    return scored(text)
