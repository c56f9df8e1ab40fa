"""Language identification with a small byte convolutional network trained here.

Bytes are mapped to classes (ASCII letters without case, the other bytes as they are, white space and
digits as one class each). Filters of two, three and four bytes slide over fixed-length windows, the
largest response of each filter in a window is kept, and a softmax layer scores the languages. The
filters are linear in the byte classes, so a filter bank of two or three bytes is one look-up of a table
per position, one of four bytes two look-ups. A text's score is the mean over all its windows.

Training takes a bounded sample of labelled rows and plain gradient descent with momentum in numpy; the
same rows give the same network whatever the partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipstat.llm.common import TEXT_ROWS, short_batches
from clipstat.session import ship_package

#: Bytes of a window, filters of each width, labelled documents per language and windows per document in the sample.
WINDOW, FILTERS, DOCS_PER_LANG, WINDOWS_PER_DOC = 256, 12, 400, 3
WIDTHS = (2, 3, 4)
UNKNOWN = "und"
EPOCHS, BATCH, RATE = 12, 64, 0.01


def _classes() -> np.ndarray:
    """Class of every byte: 0 other ASCII, 1 white space, 2 digit, letters, then high bytes."""
    out = np.zeros(256, np.int64)
    out[[9, 10, 11, 12, 13, 32]] = 1
    out[48:58] = 2
    out[65:91] = out[97:123] = np.arange(3, 29)
    out[128:192] = 29 + np.arange(64) % 32
    out[192:256] = 61 + np.arange(64) % 8
    return out


CLASS = _classes()
N_CLASSES = int(CLASS.max()) + 1


@dataclass
class Network:
    langs: list[str]
    filters: list[np.ndarray]  # (width, class, filter) each
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def tables(self) -> list[tuple[np.ndarray, int]]:
        """Look-up tables of summed responses, each with the number of bytes that index it."""
        two, three, four = self.filters
        pair = lambda f, a: (f[a][:, None] + f[a + 1][None]).reshape(N_CLASSES**2, -1)
        triple = (three[0][:, None, None] + three[1][None, :, None] + three[2][None, None]).reshape(N_CLASSES**3, -1)
        return [(t.astype(np.float32), n) for t, n in ((pair(two, 0), 2), (triple, 3), (pair(four, 0), 4), (pair(four, 2), 4))]


def windows(text: bytes, length: int = WINDOW) -> np.ndarray:
    """A text's bytes as rows of classes; the last row is filled with white space."""
    raw = CLASS[np.frombuffer(text, np.uint8)]
    rows = max(1, -(-len(raw) // length))
    out = np.full(rows * length, 1, np.int64)
    out[: len(raw)] = raw
    return out.reshape(rows, length)


def pooled(coded: np.ndarray, tables: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Largest response of every filter in every window (before the bias)."""
    two = coded[:, :-1] * N_CLASSES + coded[:, 1:]
    three = two[:, :-1] * N_CLASSES + coded[:, 2:]
    first, second, head, tail = (t for t, _ in tables)
    return np.concatenate(
        [first[two].max(1), second[three].max(1), (head[two[:, :-2]] + tail[two[:, 2:]]).max(1)], axis=1
    )


def probabilities(network: Network, tables, coded: np.ndarray) -> np.ndarray:
    hidden = np.maximum(pooled(coded, tables) + network.bias, 0)
    raw = hidden @ network.dense + network.dense_bias
    raw = np.exp(raw - raw.max(1, keepdims=True))
    return raw / raw.sum(1, keepdims=True)


def train(examples: list[tuple[bytes, str]], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """A network from one-window byte strings with their languages."""
    langs = sorted({lang for _, lang in examples})
    rng = np.random.default_rng(seed)
    filters = [rng.normal(0, 0.3, (w, N_CLASSES, FILTERS)) for w in WIDTHS]
    hidden = FILTERS * len(WIDTHS)
    net = Network(langs, filters, np.zeros(hidden), rng.normal(0, 0.3, (hidden, len(langs))), np.zeros(len(langs)))
    if not examples:
        return net
    coded = np.concatenate([windows(text)[:1] for text, _ in examples])
    truth = np.array([langs.index(lang) for _, lang in examples])
    parts = [*net.filters, net.bias, net.dense, net.dense_bias]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(coded))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            step += 1
            slopes = _slopes(net, coded[rows], truth[rows])
            for p, g, m, v in zip(parts, slopes, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _slopes(net: Network, coded: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy, in the order filters, bias, dense, dense bias."""
    n, length = coded.shape
    responses, places = [], []
    for f in net.filters:
        width = len(f)
        value = sum(f[j][coded[:, j : length - width + 1 + j]] for j in range(width))
        at = value.argmax(1)
        places.append(at)
        responses.append(np.take_along_axis(value, at[:, None], 1)[:, 0])
    before = np.concatenate(responses, 1) + net.bias
    hidden = np.maximum(before, 0)
    raw = hidden @ net.dense + net.dense_bias
    p = np.exp(raw - raw.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(n), truth] -= 1
    p /= n
    back = (p @ net.dense.T) * (before > 0)
    out = []
    for k, (f, at) in enumerate(zip(net.filters, places)):
        slope, part = np.zeros_like(f), back[:, k * FILTERS : (k + 1) * FILTERS]
        for j in range(len(f)):
            np.add.at(slope[j], (coded[np.arange(n)[:, None], at + j], np.arange(FILTERS)[None]), part)
        out.append(slope)
    return [*out, back.sum(0), hidden.T @ p, p.sum(0)]


def sample(labelled: DataFrame, per_lang: int = DOCS_PER_LANG, seed: int = 7, most_langs: int | None = None) -> list[tuple[bytes, str]]:
    """Windows of at most ``per_lang`` documents of each language, by a hash of the text.

    Takes ``text`` and ``lang``. The cut of a text's windows is made by Spark: at most ``WINDOWS_PER_DOC``
    pieces spread evenly over the whole text come to the driver. Every language is learned, at some 0.3 MB of
    sample each; with ``most_langs`` only the most frequent ones, and no text is then given to another.
    """
    usable = labelled.filter(F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumn("code", F.xxhash64(F.lit(seed), "text"))
    if most_langs is not None:
        common = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs).select("lang")
        usable = usable.join(common, "lang", "left_semi")
    order = Window.partitionBy("lang").orderBy("code")
    # At most per_lang rows of a language; only then are texts touched again.
    chosen = usable.select("lang", "code").distinct().withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= per_lang)
    size = F.length("text")
    pieces = [
        F.substring("text", (F.floor(size * k / WINDOWS_PER_DOC) + 1).cast("int"), F.lit(WINDOW)) for k in range(WINDOWS_PER_DOC)
    ]
    met = usable.join(chosen, ["lang", "code"])
    rows = met.groupBy("lang", "_n").agg(F.min(F.array(*pieces)).alias("parts")).collect()
    found = []
    for row in sorted(rows, key=lambda r: (r["lang"], r["_n"])):
        parts = dict.fromkeys(p for p in row["parts"] if any(c.isalpha() for c in p))
        found += [(p.encode()[:WINDOW], row["lang"]) for p in parts]
    return found


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predicted(text: Column, network: Network) -> Column:
    """Struct of lang_pred and score; texts that are null or have no letter are ``und`` with score 0."""
    holder: list = []

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judge(texts: pa.Array) -> pa.Array:
        if not holder:
            holder.append(network.tables())
        langs, scores = [], []
        for raw in (t for start in range(0, len(texts), TEXT_ROWS) for t in texts.slice(start, TEXT_ROWS).cast(pa.binary()).to_pylist()):
            if raw is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            coded = windows(raw)
            share = np.full(len(coded), 1 / max(len(raw), 1))
            share[:-1] *= WINDOW
            share[-1] *= len(raw) - WINDOW * (len(coded) - 1)
            total = np.zeros(len(network.langs))
            for begin in range(0, len(coded), 64):
                total += share[begin : begin + 64] @ probabilities(network, holder[0], coded[begin : begin + 64])
            best = int(total.argmax())
            langs.append(network.langs[best])
            scores.append(min(1.0, max(0.0, float(total[best]))))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    known = F.when(has_letter(text), text)
    # A filter on the prediction must not run the network a second time below the projection.
    return judge.asNondeterministic()(known if network.langs else F.lit(None).cast("string"))


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learned(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network:
    """A network from the labelled rows of ``df`` that are not held out.

    Without any usable label it has no languages, and ``predicted`` gives ``und`` for every text.
    """
    return train(sample(df.filter(~held_out(F.col(doc_id))).select(F.col(text).alias("text"), F.col(lang).alias("lang"))))


def identified(df: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """The rows of ``df`` with ``_lang``: a struct of lang_pred and score."""
    ship_package(df.sparkSession)
    short_batches(df.sparkSession)
    return df.withColumn("_lang", predicted(F.col(text), network))
