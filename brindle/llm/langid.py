"""Language identification by family first, then one-versus-one linear SVMs within the family."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import common

#: Families of languages by ISO 639-1 code. A language that is missing is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi".split(),
    "romance": "ca es fr gl it la oc pt rm ro".split(),
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk".split(),
    "baltic": "lt lv".split(),
    "uralic": "et fi hu".split(),
    "turkic": "az kk ky tr uz".split(),
    "indic": "bn gu hi mr ne pa ur".split(),
    "celtic": "br cy ga gd".split(),
}
BUCKETS = 1 << 12
#: Hash values of letter triples that a model remembers as seen, a bit each.
SEEN = 1 << 18
UND = "und"


def family(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((k for k, v in FAMILIES.items() if code in v), f"lang:{code}")


def _grams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashes of the whole text's letter pairs and of its triples around a letter, None without a letter.

    Letters are lower-cased; anything else is one blank, so that signs and digits do not count.
    """
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(_letters()[points], points, 32).astype(np.uint32)
    if (c == 32).all():
        return None
    pair = c[:-1] * np.uint32(2654435761) ^ c[1:] * np.uint32(2246822519)
    triple = pair[:-1] * np.uint32(3266489917) ^ c[2:] * np.uint32(668265263)
    pair, triple = pair[(c[:-1] != 32) | (c[1:] != 32)], triple[c[1:-1] != 32]
    return pair * np.uint32(374761393), triple * np.uint32(374761393)


def _vector(pair: np.ndarray, triple: np.ndarray) -> np.ndarray:
    shift = np.uint32(32 - 12)
    x = np.sqrt(np.bincount(pair >> shift, minlength=BUCKETS) + np.bincount(triple >> shift, minlength=BUCKETS), dtype=np.float32)
    return x / np.linalg.norm(x)


def features(text: str) -> np.ndarray | None:
    """Unit vector of square roots of counts of hashed letter pairs and triples of the whole text, None without a letter."""
    found = _grams(text)
    return None if found is None else _vector(*found)


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        import sys

        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def linear_svm(x: np.ndarray, sign: np.ndarray, c: float = 10.0, rounds: int = 200) -> np.ndarray:
    """Weights (the last is the bias) of an L2 linear SVM with squared hinge loss, by accelerated gradients.
    Both signs weigh alike in sum."""
    n, d = x.shape
    weight = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())) * c
    w = np.zeros(d + 1)
    y, t = w.copy(), 1.0
    sign = sign.astype(x.dtype)
    weight = weight.astype(x.dtype)  # one type, so that no round copies x
    step = 1 / (1 + 4 * c)  # rows and bias have unit norm
    for _ in range(rounds):
        z = y.astype(x.dtype)
        slack = np.maximum(0, 1 - sign * (x @ z[:d] + z[d]))
        g = -2 * weight * slack * sign
        grad = np.append(g @ x, g.sum()) + np.append(y[:d], 0)
        new = y - step * grad
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return w


@dataclass
class Model:
    """Weights by family (one versus rest) and by pair of languages within a family."""

    families: dict[str, list[str]]
    top: np.ndarray  # a row a family, in the order of ``families``
    pairs: dict[tuple[str, str], np.ndarray]
    seen: np.ndarray  # whether a triple was there in training, by hash

    def predict(self, text: str | None) -> tuple[str, float]:
        found = _grams(text) if text else None
        return (UND, 0.0) if found is None or not self.families else self._decide(_vector(*found))

    def known(self, text: str | None, share: float) -> bool:
        """Whether the text is in a language like those of the training: at most ``share`` of its letter triples were
        not there, with an allowance for short texts of the square root of their number."""
        found = _grams(text) if text else None
        if found is None or not self.families:
            return False
        triple = found[1]
        new = len(triple) - int(np.count_nonzero(self.seen[triple >> np.uint32(32 - 18)]))
        return new <= share * len(triple) + np.sqrt(len(triple))

    def _decide(self, x: np.ndarray) -> tuple[str, float]:
        names = list(self.families)
        margins = self.top[:, :-1] @ x + self.top[:, -1]
        best = int(np.argmax(margins))
        p = _softmax(margins)[best] if len(names) > 1 else 1.0
        langs = self.families[names[best]]
        if len(langs) == 1:
            return langs[0], float(p)
        wins = dict.fromkeys(langs, 0.0)
        for a, b in ((a, b) for i, a in enumerate(langs) for b in langs[i + 1 :]):
            w = self.pairs[a, b]
            q = 1 / (1 + np.exp(-4 * float(w[:-1] @ x + w[-1])))
            wins[a] += q
            wins[b] += 1 - q
        lang = max(langs, key=wins.get)
        return lang, float(p * wins[lang] / (len(langs) - 1))


def _softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(4 * (margins - margins.max()))
    return e / e.sum()


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", per_lang: int = 1200, max_langs: int = 200, max_rows: int = 16_000) -> Model:
    """Fit on a bounded sample of labelled texts: of each of the ``max_langs`` most frequent languages about ``per_lang``
    distinct texts (all, where there are fewer; fewer where the languages are many), picked by a hash of the text, so
    the same each time, and no more than twice ``max_rows`` in all reach the driver.

    Rows with a null language or a text without letters are left out, and copies of a text count once. An empty table
    gives a model that predicts und.
    """
    rows = df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(max_langs).collect()}
    if not counts:
        return Model({}, np.zeros((0, BUCKETS + 1), np.float32), {}, np.zeros(SEEN, bool))
    each = min(per_lang, max_rows // len(counts))
    threshold = F.coalesce(*(F.when(F.col("lang") == k, F.lit(int(min(1.0, each / max(n, 1)) * 2**31))) for k, n in counts.items()), F.lit(0))
    sample = rows.withColumn("name", F.xxhash64("text")).where(F.pmod("name", F.lit(2**31)) < threshold)
    sample = sample.groupBy("lang", "name").agg(F.first("text").alias("text")).select("text", "lang")  # copies count once
    sample = common.staged(sample, "language-sample")
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("x", T.BinaryType())])

    def vectors(batch):
        found = [(lang, _grams(text.as_py())) for lang, text in zip(batch.column(1).to_pylist(), batch.column(0))]
        found = [(lang, g) for lang, g in found if g is not None]
        return common.batch(schema, [[lang for lang, _ in found], [_vector(*g).astype(np.float16).tobytes() for _, g in found]])

    def triples(batch):
        found = [g[1] >> np.uint32(32 - 18) for g in (_grams(text.as_py()) for text in batch.column(0)) if g is not None]
        return common.batch(places, [pa.array(np.unique(np.concatenate(found)).astype(np.int32) if found else [], pa.int32())])

    places = T.StructType([T.StructField("place", T.IntegerType())])
    data = common.map_batches(sample, vectors, schema).limit(2 * max_rows).collect()
    seen = np.zeros(SEEN, bool)
    # of the whole sample, however many batches it has: at most SEEN numbers
    seen[common.map_batches(sample.select("text"), triples, places).distinct().toArrow()["place"].to_numpy()] = True
    common.drop(sample)
    data = sorted(data, key=lambda r: (r["lang"], bytes(r["x"])))
    langs = sorted({r["lang"] for r in data})
    y = np.array([r["lang"] for r in data])
    x = np.frombuffer(b"".join(r["x"] for r in data), np.float16).reshape(-1, BUCKETS).astype(np.float32)
    del data
    groups: dict[str, list[str]] = {}
    for lang in langs:
        groups.setdefault(family(lang), []).append(lang)
    fam = np.array([family(v) for v in y])
    top = np.array([linear_svm(x, np.where(fam == f, 1.0, -1.0)) for f in groups]).reshape(len(groups), -1).astype(np.float32)
    pairs = {}
    for some in groups.values():
        for a, b in ((a, b) for i, a in enumerate(some) for b in some[i + 1 :]):
            m = (y == a) | (y == b)
            pairs[a, b] = linear_svm(x[m], np.where(y[m] == a, 1.0, -1.0)).astype(np.float32)
    return Model(groups, top, pairs, seen)


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(df: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Rows (doc_id, lang_pred, score) for every row, from the text alone; und and 0 where it is null or has no letter."""
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batch):
        found = [model.predict(t.as_py()) for t in batch.column(1)]
        return common.batch(schema, [batch.column(0), [f[0] for f in found], [f[1] for f in found]])

    return common.map_batches(common.ids_and_texts(df, id_col, text_col), run, schema)


def keep_identified(df: DataFrame, model: Model, text_col: str = "text", max_new: float = 0.4) -> DataFrame:
    """The rows whose text has a language, all columns as they are: it has a letter, and no more than ``max_new`` of its
    letter triples (and an allowance for short texts) were absent from the training texts of all languages. So a text in
    a language that was not learned, or letters without sense, goes however many languages there are.

    Null texts and texts without a letter go; repeated rows stay or go alike; ids are not read. An empty table, and any
    table with a model of no language, gives no rows. Only texts travel to Python, and a flag back.
    """
    common.bound_batches(df.sparkSession)

    @F.arrow_udf(T.BooleanType())
    def known(texts: pa.Array) -> pa.Array:
        return pa.array([model.known(t.as_py(), max_new) for t in texts], pa.bool_())

    return df.where(known(F.col(f"`{text_col}`").cast("string")))
