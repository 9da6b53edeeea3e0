"""Language identification by averaged hashed subword embeddings (operator 10).

Subwords are the byte 3-grams and 4-grams of the folded text (white space
becomes one blank, so grams carry word starts and ends).  Each gram hashes to
a row of an embedding table; a text is the mean of the rows of all its grams; a
linear softmax reads the language from the mean.  The model has this one form
for any number of languages.

Table and softmax are trained together by stochastic gradient descent in numpy
on a bounded sample of labelled rows, read whole: about ``max_sample`` texts and
``max_bytes`` of text in all, drawn evenly by language, or ``MIN_EACH`` texts of
every language if that is more.  A hash of id and text decides whether a row is
drawn, and rows that repeat both count once, so the sample does not depend on the
order of the rows and no repeated id crowds others out.  A drawn text becomes its
distinct table rows with their shares, at most 2 * ``BUCKETS`` of them however
long it is.  Every label that occurs is learned; more than ``MAX_LABELS`` of them
are an error, as then the column does not hold languages.  One part in five of
the sample calibrates: a temperature makes the softmax's confidence honest, and
the rejection threshold is the confidence that all but ``FALSE_REJECT`` of the
calibration texts reach, 0.5 at most.

Prediction covers the whole text, in blocks of ``BLOCK`` bytes, which keeps its
memory flat for very long texts.

Defined cases: a null text or one without a letter is ``und`` with score 0 and
rejected, and never learned from; without labelled rows every text is ``und``;
a null id is predicted but never learned from; repeated rows are predicted alike; of
equal probabilities the label that sorts first wins; columns beyond id,
text and label are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from revisor.llm.common import numbered, rename_free, slices, string_views
from revisor.llm.hashing import FOLD, IS_SPACE

BUCKETS = 1 << 16  # for either gram length
DIMENSIONS = 32
MAX_SAMPLE = 6000
MAX_SAMPLE_BYTES = 32 << 20
MIN_EACH = 30
MAX_LABELS = 4096
EPOCHS = 8
BLOCK = 1 << 14
BATCH = 32
RATE = 4.0
FALSE_REJECT = 0.001
UNKNOWN = "und"

_CLEAN = FOLD.copy()
_CLEAN[IS_SPACE] = 32
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[65:91] = True
_IS_LETTER[97:123] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(data: np.ndarray) -> np.ndarray:
    """Table rows of all 3-grams and 4-grams of a text, blanks around it included."""
    text = np.full(len(data) + 2, 32, dtype=np.uint32)
    text[1:-1] = _CLEAN[data]
    three = text[:-2] | text[1:-1] << np.uint32(8) | text[2:] << np.uint32(16)
    four = three[:-1] | text[3:] << np.uint32(24)
    shift = np.uint32(16)
    return np.concatenate([(three * np.uint32(0x9E3779B1)) >> shift,
                           ((four * np.uint32(0x85EBCA6B)) >> shift) + np.uint32(BUCKETS)])


def has_letter(data: np.ndarray) -> bool:
    if _IS_LETTER[data].any():
        return True
    if not (data >= 128).any():
        return False
    return any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def gram_shares(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a text's grams, and the share of each."""
    found = [np.unique(_block(data, at, 1 << 20), return_counts=True) for at in range(0, max(1, len(data)), 1 << 20)]
    rows, counts = found[0]
    if len(found) > 1:
        total = np.zeros(2 * BUCKETS, dtype=np.int64)
        for own, n in found:
            total[own] += n
        rows = np.flatnonzero(total)
        counts = total[rows]
    return rows, (counts / counts.sum()).astype(np.float32)


def _block(data: np.ndarray, at: int, size: int) -> np.ndarray:
    """Table rows of one block's grams; blocks overlap by the three bytes before them."""
    return grams(data[max(0, at - 3):at + size])


class LanguageModel:
    """``table`` holds embeddings of the grams; ``weight`` and ``bias`` make logits of their mean."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, threshold: float,
                 weight: np.ndarray | None = None):
        self.languages, self.table, self.bias = languages, table, bias
        self.weight = np.eye(table.shape[1]) if weight is None else weight
        self.temperature, self.threshold = temperature, threshold

    def predict(self, data: np.ndarray | None) -> tuple[str, float, bool]:
        """Language, calibrated confidence and whether to reject, of one whole text."""
        if data is None or not self.languages or not has_letter(data):
            return UNKNOWN, 0.0, True
        total, n = np.zeros(self.table.shape[1]), 0
        for at in range(0, len(data), BLOCK):
            rows = _block(data, at, BLOCK)
            total += self.table.take(rows, axis=0).sum(axis=0)
            n += len(rows)
        logits = (total / n @ self.weight + self.bias) / self.temperature
        p = np.exp(logits - logits.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] < self.threshold)


def _softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _mean(embed: np.ndarray, text: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    # einsum stays on one core: products this small would only keep BLAS threads spinning
    return np.einsum("i,ij->j", text[1], embed.take(text[0], axis=0))


def fit(languages: list[str], labels: np.ndarray, texts: list[tuple[np.ndarray, np.ndarray]], seed: int = 7) -> LanguageModel:
    """SGD on labels and the gram shares of their texts, then calibration on every fifth text."""
    rng = np.random.default_rng(seed)
    n = len(languages)
    held = np.arange(len(labels)) % 5 == 4
    if held.sum() < n or n < 2:
        held[:] = False
    train = np.flatnonzero(~held)
    embed = rng.normal(0, 0.1, (2 * BUCKETS, DIMENSIONS)).astype(np.float32)
    weight = rng.normal(0, 0.1, (DIMENSIONS, n)).astype(np.float32)
    bias = np.zeros(n, dtype=np.float32)
    steps = EPOCHS * max(1, -(-len(train) // BATCH))
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            own = train[at:at + BATCH]
            mean = np.stack([_mean(embed, texts[i]) for i in own])
            error = _softmax(mean @ weight + bias)
            error[np.arange(len(own)), labels[own]] -= 1
            error /= len(own)
            rate = np.float32(RATE * (1 - step / steps))
            back = error @ weight.T * (rate * BATCH)
            weight -= rate * (mean.T @ error)
            bias -= rate * error.sum(axis=0)
            # a text's gradient is spread over all its grams; the mean makes it small, so scale it up
            for i, change in zip(own, back):
                rows, shares = texts[i]
                embed[rows] = embed.take(rows, axis=0) - shares[:, None] * change
            step += 1
    temperature, threshold = 1.0, 0.0
    if held.any():
        logits = np.stack([_mean(embed, texts[i]) for i in np.flatnonzero(held)]) @ weight + bias
        truth = labels[held]
        loss = [(-np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean(), t)
                for t in np.geomspace(0.05, 20, 61)]
        temperature = float(min(loss)[1])
        reached = _softmax(logits / temperature).max(axis=1)
        threshold = float(min(0.5, np.quantile(reached, FALSE_REJECT)))
    return LanguageModel(languages, embed, bias, temperature, threshold, weight)


def drawn(rows: DataFrame, counts: list, max_sample: int, max_bytes: int) -> DataFrame:
    """The sample of (doc_id, text, lang) rows: columns ``own``, a hash of id and text, ``lang`` and ``text``.

    ``counts`` has the number of rows and the mean bytes of each language.
    """
    each = max(max_sample // len(counts), MIN_EACH)
    scale = 1 << 30
    shares = []
    for r in counts:
        fitting = max_bytes / len(counts) / max(1.0, r["bytes"])
        shares.append((r["lang"], min(scale, int(scale * max(MIN_EACH, min(each, fitting)) / max(1, r["n"])))))
    table = rows.sparkSession.createDataFrame(shares, "lang string, share long")
    return (rows.select(_own().alias("own"), "lang", "text").join(F.broadcast(table), "lang")
            .filter(F.pmod("own", F.lit(scale)) < F.col("share")).drop("share").dropDuplicates(["own", "lang"]))


def _own() -> Column:
    return F.xxhash64(F.lit(17), F.col("doc_id"), F.col("text"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_sample: int = MAX_SAMPLE, max_bytes: int = MAX_SAMPLE_BYTES) -> LanguageModel:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    rows = rename_free(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("lang", F.col("lang").cast("string"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                       & ~held_out(F.col("doc_id")))
    counts = (rows.groupBy("lang").agg(F.approx_count_distinct(_own()).alias("n"), F.avg(F.octet_length("text")).alias("bytes"))
              .limit(MAX_LABELS + 1).collect())
    if len(counts) > MAX_LABELS:
        raise ValueError(f"{lang_col} holds more than {MAX_LABELS} labels")
    languages = sorted(r["lang"] for r in counts)
    untrained = LanguageModel([], np.zeros((2 * BUCKETS, 0), np.float32), np.zeros(0), 1.0, 0.0)
    if not languages:
        return untrained

    def features(batches):
        for batch in slices(batches):
            views = list(string_views(batch.column("text")))
            pairs = [gram_shares(data) for data in views]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), batch.column("lang"), pa.array([r.astype("<u4").tobytes() for r, _ in pairs], pa.binary()),
                 pa.array([w.astype("<f4").tobytes() for _, w in pairs], pa.binary())],
                names=["own", "lang", "rows", "shares"]).filter(pa.array([has_letter(data) for data in views]))

    sample = drawn(rows, counts, max_sample, max_bytes).mapInArrow(features, "own long, lang string, rows binary, shares binary").toArrow()
    order = sorted(zip(*[sample.column(c).to_pylist() for c in ("own", "lang", "rows", "shares")]))
    if not order:
        return untrained
    index = {name: i for i, name in enumerate(languages)}
    labels = np.array([index[lang] for _, lang, _, _ in order], dtype=np.int64)
    return fit(languages, labels, [(np.frombuffer(r, dtype="<u4"), np.frombuffer(w, dtype="<f4")) for _, _, r, w in order])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: the id, ``lang_pred``, ``score``, ``rejected``."""
    return _predicted(rename_free(docs, doc_id=id_col, text=text_col), 1, model).drop("c1").toDF(
        id_col, "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The documents whose language the model does not reject, with all their columns."""
    found = _predicted(docs, docs.columns.index(text_col), model).filter("NOT rejected")
    return found.drop("lang_pred", "score", "rejected").toDF(*docs.columns)


def _predicted(docs: DataFrame, text_at: int, model: LanguageModel) -> DataFrame:
    """The columns as ``c0, c1, ...`` and ``lang_pred``, ``score``, ``rejected`` after them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = numbered(docs)
    names = [*rows.columns, "lang_pred", "score", "rejected"]

    def predict(batches):
        model = shared.value
        for batch in slices(batches):
            lang, score, rejected = zip(*[model.predict(data) for data in string_views(batch.column(text_at))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=names)

    schema = StructType(rows.schema.fields + [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                                              StructField("rejected", BooleanType())])
    return rows.mapInArrow(predict, schema)
