"""Quality classifier by co-training of two views.

One classifier sees a document's text (style figures and a lexicon of telling words),
the other its page metadata (language, source, size).  Both are logistic regressions,
calibrated on labelled documents held out.  For some rounds each view labels all
unlabelled documents that it is sure of, for the other view to learn from: tasks score
the whole corpus and add up the sums of a Newton step, so nothing but those sums, whose
size the model gives, is gathered.  All documents are then scored by the two calibrated
views together."""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.store import if_few, ship, stored
from tillroll.llm.worker_memory import claim


@dataclass(frozen=True)
class Settings:
    labelled: int = 8_000    # labelled documents that are learned from, at most
    lexicon: int = 256       # words kept as features
    least_docs: int = 5      # labelled documents that a lexicon word stands in
    rounds: int = 3
    sure: float = 0.97       # calibrated probability from which a view labels for the other
    steps: int = 3           # Newton steps of a view in a round
    trust: float = 1.0       # weight of all pseudo-labels of a class, against its labelled documents
    held_out: int = 5        # one document in so many calibrates
    least_good: float = 0.35  # documents of a lower score are rejected


_UPPER, _DIGIT, _SYMBOL = (bytes(x, "ascii") for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>{}=_~^\\"))
_STYLE = 12
_LANGS, _SOURCES = 16, 64


def word_set(text: str | None) -> set[str]:
    return {w.strip(".,;:!?\"'()") for w in (text or "").lower().split()}


def content_features(text: str | None, lexicon: dict[str, int]) -> np.ndarray:
    """Style of the whole text, then one figure per lexicon word that stands in it."""
    claim("features")
    out = np.zeros(_STYLE + len(lexicon), np.float32)
    words = (text or "").split()
    if not words:
        return out
    raw, n = text.encode("utf-8", "surrogatepass"), len(words)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    share = lambda letters: (len(raw) - len(raw.translate(None, letters))) / n
    out[:_STYLE] = (1.0, np.log1p(n) / 5, (len(text) - n) / n / 5, min(share(_SYMBOL), 3.0), min(share(_UPPER), 5.0) / 2,
                    min(share(_DIGIT), 5.0), min(text.count("!") / n, 2.0), text.count("|") / n,
                    # distinct words fall with length, as a power of it
                    len(counts) / n ** 0.85, counts.most_common(1)[0][1] / n,
                    sum(map(operator.eq, words, words[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)))
    if lexicon:
        for w in lexicon.keys() & word_set(text):
            out[_STYLE + lexicon[w]] = 1.0
    return out


def metadata_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(3 + _LANGS + _SOURCES, np.float32)
    size = np.log1p(max(n_chars or 0, 0)) / 8
    out[:3] = 1.0, size, size * size
    out[3 + zlib.crc32((lang or "").encode()) % _LANGS] = 1.0
    out[3 + _LANGS + zlib.crc32((source or "").encode()) % _SOURCES] = 1.0
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 2.0, w: np.ndarray | None = None, steps: int = 25, more=None) -> np.ndarray:
    """Ridge logistic regression by Newton steps from ``w``; the first column is the
    constant.  ``more(w)`` adds the curvature and slope of further rows."""
    w = np.zeros(x.shape[1]) if w is None else w.copy()
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = _sigmoid(x @ w)
        curve, slope = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w
        if more is not None:
            also = more(w)
            if also is None:  # no further rows
                more = None
            else:
                curve, slope = curve + also[0], slope + also[1]
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class View:
    weights: np.ndarray
    scale: np.ndarray  # calibration: logit = scale[0] + scale[1] * raw

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, held: np.ndarray, y_held: np.ndarray) -> View:
        return cls.calibrated(_logistic(x.astype(np.float64), y), held, y_held)

    @classmethod
    def calibrated(cls, w: np.ndarray, held: np.ndarray, y_held: np.ndarray) -> View:
        raw = held @ w
        scale = _logistic(np.column_stack([np.ones(len(raw)), raw]), y_held, 0.1) if len(set(y_held)) == 2 else np.array([0.0, 1.0])
        if scale[1] <= 0:  # a view that tells nothing says the rate alone
            scale = np.array([np.log(y_held.mean() / (1 - y_held.mean())), 0.0])
        return cls(w, scale)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.scale[0] + self.scale[1] * (x @ self.weights)


@dataclass
class Model:
    lexicon: dict[str, int] = field(default_factory=dict)
    content: View | None = None
    metadata: View | None = None
    prior: float = 0.0  # logit of a good document

    def score(self, content: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of a good document by text, by metadata and by both (taken as
        independent given the class)."""
        if self.content is None:
            p = np.full(len(content), _sigmoid(np.array(self.prior)))
            return p, p, p
        a, b = self.content.logit(content), self.metadata.logit(metadata)
        return _sigmoid(a), _sigmoid(b), _sigmoid(a + b - self.prior)


def _features(docs: DataFrame, lexicon: dict[str, int]) -> DataFrame:
    """(doc_id, good, c, m) of a sample of documents, both vectors as 32-bit floats."""
    def run(batches):
        for b in batches:
            texts, rest = b.column(2), [b.column(k).to_pylist() for k in (3, 4, 5)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1),
                 pa.array([content_features(texts[k].as_py(), lexicon).tobytes() for k in range(b.num_rows)], pa.binary()),
                 pa.array([metadata_features(*x).tobytes() for x in zip(*rest)], pa.binary())], ["doc_id", "good", "c", "m"])

    return docs.select("doc_id", "good", "text", "lang", "source", "n_chars").mapInArrow(
        run, "doc_id long, good int, c binary, m binary")


def _matrix(rows, name: str) -> np.ndarray:
    return np.frombuffer(b"".join([r[name] for r in rows]), np.float32).reshape(len(rows), -1).astype(np.float64)


def _lexicon(sample: DataFrame, s: Settings) -> dict[str, int]:
    """Words whose documents are good or bad far beyond the rate of all."""
    def run(batches):
        for b in batches:
            texts, pairs = b.column(1), []
            for k, good in enumerate(b.column(0).to_pylist()):
                pairs += [(w, good) for w in word_set(texts[k].as_py()) if w]
            cols = list(zip(*pairs)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32())], ["word", "good"])

    words = sample.select("good", "text").mapInArrow(run, "word string, good int") \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("k"))
    rate = sample.agg(F.avg("good")).first()[0]
    odd = (F.col("k") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    top = words.where(F.col("n") >= s.least_docs).withColumn("odd", F.abs(odd)).where("odd > 3") \
        .orderBy(F.desc("odd"), "word").limit(s.lexicon).collect()
    return {r["word"]: i for i, r in enumerate(top)}


def _compact(docs: DataFrame, lexicon: dict[str, int]) -> DataFrame:
    """(doc_id, style, words, meta): the features of documents in few bytes: style figures,
    a bit per lexicon word, and the metadata's figures that aren't zero."""
    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                b = batch.slice(begin, 512)
                c = np.array([content_features(x, lexicon) for x in b.column(1).to_pylist()])
                bits = np.packbits(c[:, _STYLE:] > 0, axis=1)
                m = [metadata_features(*x) for x in zip(*(b.column(k).to_pylist() for k in (2, 3, 4)))]
                meta = [np.r_[x[:3], np.flatnonzero(x[3:]) + 3].astype(np.float32).tobytes() for x in m]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([x.tobytes() for x in c[:, :_STYLE]], pa.binary()), pa.array([x.tobytes() for x in bits], pa.binary()),
                     pa.array(meta, pa.binary())], ["doc_id", "style", "words", "meta"])

    return docs.mapInArrow(run, "doc_id long, style binary, words binary, meta binary")


def _wide(batch: pa.RecordBatch, n_words: int) -> dict[str, np.ndarray]:
    """Both views' features of a batch of ``_compact`` rows."""
    n = batch.num_rows
    style, words, meta = (b"".join(batch.column(k).to_pylist()) for k in (1, 2, 3))
    bits = np.frombuffer(words, np.uint8).reshape(n, -1) if words else np.zeros((n, 0), np.uint8)
    content = np.hstack([np.frombuffer(style, np.float32).reshape(n, _STYLE), np.unpackbits(bits, axis=1, count=n_words)]).astype(np.float64)
    few = np.frombuffer(meta, np.float32).reshape(n, 5)
    metadata = np.zeros((n, 3 + _LANGS + _SOURCES))
    metadata[:, :3] = few[:, :3]
    for k in (3, 4):
        metadata[np.arange(n), few[:, k].astype(int)] = 1.0
    return {"c": content, "m": metadata}


def _pseudo_sums(unlabelled: DataFrame, n_words: int, teacher: tuple[str, View], pupil: str, w: np.ndarray, sure: float) -> dict:
    """class → (documents, curvature, slope) of a Newton step of ``pupil`` at ``w`` over all
    documents that ``teacher`` is sure of.  Tasks add up; a second round of tasks adds
    those sums row by row; as many rows as the view has figures, a class, come back."""
    width = len(w)

    def add(batches):
        sums = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                x = _wide(batch.slice(begin, 4096), n_words)
                p = _sigmoid(teacher[1].logit(x[teacher[0]]))
                for y, chosen in ((1, p >= sure), (0, 1 - p >= sure)):
                    if chosen.any():
                        own = x[pupil][chosen]
                        q = _sigmoid(own @ w)
                        row = np.column_stack([(own * (q * (1 - q))[:, None]).T @ own, own.T @ (y - q), np.full(width, len(own))])
                        sums[y] = sums[y] + row if y in sums else row
        for y, rows in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(width, y, np.int32)), pa.array(np.arange(width, dtype=np.int32)),
                                              pa.array([r.tobytes() for r in rows], pa.binary())], ["y", "i", "row"])

    def merge(batches):
        sums: dict = {}
        for batch in batches:
            for y, i, row in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.frombuffer(row)
                sums[y, i] = sums[y, i] + x if (y, i) in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int32()),
                                              pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["y", "i", "row"])

    schema = "y int, i int, row binary"
    rows = unlabelled.mapInArrow(add, schema).repartition("y", "i").mapInArrow(merge, schema).collect()  # 2 * width rows at most
    out = {}
    for y in {r["y"] for r in rows}:
        table = np.array([np.frombuffer(r["row"]) for r in sorted((r for r in rows if r["y"] == y), key=lambda r: r["i"])])
        out[y] = (table[0, -1], table[:, :width], table[:, width])
    return out


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from ``docs`` (doc_id, text, lang, source, n_chars) and ``labels`` (doc_id,
    good 0/1).  At most ``labelled`` labelled documents are used, the first by a hash of
    their id, and all others that one of the views is sure of.  The pseudo-labels of a
    class weigh no more together than ``trust`` times its labelled documents, however many
    they are; the model's size is bounded by the settings."""
    s = settings
    named = labels.where("doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").cast("int").alias("good"))
    held = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(s.held_out)) == 0
    chosen = named.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.labelled)
    # a bounded set of ids, so the join reads texts without moving them
    ids = stored(chosen, "train-ids")
    known = stored(docs.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]), "train-texts")
    mean = known.agg(F.avg("good")).first()[0]
    if mean is None or mean in (0.0, 1.0):
        return Model(prior=0.0 if mean is None else 5.0 if mean else -5.0)
    model = Model(_lexicon(known.where(~held), s), prior=float(np.log(mean / (1 - mean))))
    rows = _features(known, model.lexicon).withColumn("held", held).orderBy("doc_id").collect()
    train, test = ([r for r in rows if r["held"] == h] for h in (False, True))
    if not train or not test or len({r["good"] for r in train}) < 2:
        return Model(prior=model.prior)
    y, y_test = (np.array([r["good"] for r in x], np.float64) for x in (train, test))
    x, x_test = ({n: _matrix(part, n) for n in "cm"} for part in (train, test))
    views = {n: View.fit(x[n], y, x_test[n], y_test) for n in "cm"}
    if s.rounds:
        n_words = len(model.lexicon)
        every = stored(_compact(docs.where("doc_id is not null"), model.lexicon), "train-features")
        others = stored(every.join(if_few(stored(named.select("doc_id"), "train-named")), "doc_id", "left_anti"), "train-unlabelled")
        labelled = {1: y.sum(), 0: len(y) - y.sum()}
    for _ in range(s.rounds):
        for teacher, pupil in (("c", "m"), ("m", "c")):
            def more(w, teacher=teacher, pupil=pupil):
                found = _pseudo_sums(others, n_words, (teacher, views[teacher]), pupil, w, s.sure)
                weigh = {k: min(1.0, s.trust * labelled[k] / n) for k, (n, _, _) in found.items()}
                return tuple(sum(weigh[k] * found[k][part] for k in found) for part in (1, 2)) if found else None

            w = _logistic(x[pupil], y, w=views[pupil].weights, steps=s.steps, more=more)
            views[pupil] = View.calibrated(w, x_test[pupil], y_test)
    model.content, model.metadata = views["c"], views["m"]
    return model


def _scores(batch: pa.RecordBatch, at: list[int], model: Model):
    """Probabilities of a batch whose columns ``at`` are text, lang, source, n_chars."""
    c, blank, texts = [], [], batch.column(at[0])
    for k in range(batch.num_rows):
        text = texts[k].as_py()
        blank.append(not (text or "").strip())
        c.append(content_features(text, model.lexicon))
    meta = [metadata_features(*x) for x in zip(*(batch.column(k).to_pylist() for k in at[1:]))]
    content, metadata, both = model.score(np.array(c), np.array(meta))
    return content, metadata, np.where(blank, 0.0, both)


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, p_content, p_metadata, score, kept) of every row; blank texts are rejected."""
    ship(docs.sparkSession)
    shared, least = docs.sparkSession.sparkContext.broadcast(model), settings.least_good

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                b = batch.slice(begin, 512)
                out = _scores(b, [1, 2, 3, 4], shared.value)
                yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x.astype(np.float64)) for x in out],
                                                  pa.array(out[2] >= least)], ["doc_id", "p_content", "p_metadata", "score", "kept"])

    return standard(docs).mapInArrow(run, "doc_id long, p_content double, p_metadata double, score double, kept boolean")


def keep_good(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` (text string, lang, source string, n_chars long, any others) that
    ``score`` keeps, in one pass over them."""
    ship(docs.sparkSession)
    shared, least = docs.sparkSession.sparkContext.broadcast(model), settings.least_good
    at = [docs.columns.index(c) for c in ("text", "lang", "source", "n_chars")]

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                b = batch.slice(begin, 512)
                yield b.filter(pa.array(_scores(b, at, shared.value)[2] >= least))

    return docs.mapInArrow(run, docs.schema)


def standard(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       F.col("n_chars").cast("long").alias("n_chars"))


def good_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good): good means quality 1 and not toxic (null toxic: not)."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).cast("int").alias("good"))


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, p_content, p_metadata, score, kept) for every row of ``docs``.

    ``labels`` (doc_id, quality, toxic) covers some documents; where ids repeat, a bad
    label wins.  Null or blank texts get score 0 and are rejected.  Null metadata is a
    value of its own.  Without labels, or with labels of one class only, all others get
    the prior.  Rows without an id are scored, not learned from; repeated rows are scored
    alike; an empty table gives an empty one; other columns are not read."""
    docs = standard(docs)
    return score(docs, fit(docs, good_labels(labels), settings), settings)
