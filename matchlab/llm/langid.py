"""Language identification: multinomial naive Bayes over hashed character n-grams.

Every n-gram of the lower-cased text (lengths ``ORDERS``, a space before and
after the text) is a feature, hashed to one of ``BUCKETS``. Tasks count the
features of all labelled training texts by language; the counts are added up
in Spark and become one matrix of log-probabilities with a row per bucket
and a column per language. Its size is ``BUCKETS`` x languages x 4 bytes,
checked against ``MATRIX_MB`` before it is broadcast; it doesn't grow with
the rows. A batch is scored by gathering the matrix rows of its n-grams and
adding them up by text.

Defined results: a null text, an empty one and one without a letter are
``und`` with score 0, and so is every text if no row is labelled; ties go to
the language that sorts first; repeated rows are scored (and counted)
repeatedly; an empty table gives an empty one; further columns are kept or
ignored, never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from matchlab.llm.common import column, held_out, slices

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 15
MATRIX_MB = 256
_PARTS = 16
_STEP = 1 << 19          # characters of a window of a long text
_SLICE = 1 << 18         # bytes of text whose n-grams are held at once


def features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order the bucket at every position of the joined texts
    (``BUCKETS`` where the n-gram would leave its text), and where texts start."""
    texts = [f" {t.lower()} " for t in texts]
    ends = np.cumsum([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(codes))    # characters to the text's end
    out, h = [], np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        tail = np.concatenate([codes[n - 1:], np.zeros(min(n - 1, len(codes)), np.uint32)])
        h = (h ^ tail) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        if n in ORDERS:
            b = ((h + np.uint32(n)) * np.uint32(0x85EBCA6B) >> np.uint32(17)).astype(np.int64)
            out.append(np.where(left >= n, b, BUCKETS))
    return out, np.concatenate([[0], ends[:-1]]).astype(np.int64)


def windows(text: str) -> list[str]:
    """A long text in consecutive windows, so batches stay small."""
    return [text[i:i + _STEP] for i in range(0, max(len(text), 1), _STEP)] if len(text) > _STEP else [text]


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and log-probability matrix [BUCKETS + 2, languages], learnt from
    all rows with a text and a language. The last row but one is zero, the last one the log-priors."""

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for part in slices(batches, most=_SLICE):
            langs = np.array(column(part, "lang").to_pylist(), object)
            texts = column(part, "text").to_pylist()
            for lang in dict.fromkeys(langs):
                own = [w for t, x in zip(texts, langs) if x == lang for w in windows(t)]
                got, _ = features(own)
                total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for b in got:
                    total += np.bincount(b, minlength=BUCKETS + 1)[:BUCKETS]
                rows[lang] = rows.get(lang, 0) + int((langs == lang).sum())
        for lang, total in sums.items():
            for k, x in enumerate(np.split(total, _PARTS)):
                yield pa.RecordBatch.from_pydict({"lang": [lang], "part": pa.array([k], pa.int32()), "rows": [rows[lang]], "counts": [x.tobytes()]})

    def add(batches):
        sums: dict[tuple, list] = {}
        for batch in batches:
            for lang, part, n, blob in zip(*(c.to_pylist() for c in batch.columns)):
                held = sums.setdefault((lang, part), [0, np.zeros(BUCKETS // _PARTS, np.int64)])
                held[0] += n
                held[1] += np.frombuffer(blob, np.int64)
        for (lang, part), (n, x) in sums.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "part": pa.array([part], pa.int32()), "rows": [n], "counts": [x.tobytes()]})

    schema = "lang string, part int, rows bigint, counts binary"
    labelled = df.where(df[text_col].isNotNull() & df[lang_col].isNotNull()).select(df[text_col].alias("text"), df[lang_col].cast("string").alias("lang"))
    sums = labelled.mapInArrow(count, schema).repartition(_PARTS, "lang", "part").mapInArrow(add, schema)
    found: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    for r in sums.toLocalIterator():        # languages x _PARTS rows
        found.setdefault(r.lang, np.zeros(BUCKETS, np.int64))[r.part * (BUCKETS // _PARTS):(r.part + 1) * (BUCKETS // _PARTS)] = np.frombuffer(r.counts, np.int64)
        docs[r.lang] = r.rows
        if len(found) * BUCKETS * 4 > MATRIX_MB << 20:
            raise ValueError(f"{len(found)} or more languages: the matrix would be larger than {MATRIX_MB} MB")
    langs = sorted(found)
    matrix = np.zeros((BUCKETS + 2, len(langs)), np.float32)
    for k, lang in enumerate(langs):
        c = found[lang] + 0.5
        matrix[:BUCKETS, k] = np.log(c / c.sum())
        matrix[BUCKETS + 1, k] = np.log(docs[lang] / sum(docs.values()))
    return langs, matrix


def predict(df: DataFrame, langs: list[str], matrix: np.ndarray, text_col: str = "text",
            pred_col: str = "lang_pred", score_col: str = "score", fit_col: str | None = None) -> DataFrame:
    """``df`` with the predicted language and its posterior probability; with
    ``fit_col``, also the mean log-probability of the text's n-grams in that
    language, and (``fit_col`` + ``_n``) their number."""
    if matrix.nbytes > (MATRIX_MB << 20) + 4096:
        raise ValueError("the matrix is too large to broadcast")
    fit = [fit_col, f"{fit_col}_n"] if fit_col else []
    if {pred_col, score_col, *fit} & set(df.columns):
        df = df.drop(pred_col, score_col, *fit)
    held = df.sparkSession.sparkContext.broadcast(matrix)
    schema = StructType([*df.schema.fields, StructField(pred_col, StringType()), StructField(score_col, DoubleType()),
                         *(StructField(c, kind()) for c, kind in zip(fit, (DoubleType, LongType)))])

    def run(batches):
        m = held.value[:BUCKETS + 1]
        prior = held.value[BUCKETS + 1].astype(np.float64)
        for part in slices(batches, text_col, most=_SLICE):
            texts = [t or "" for t in column(part, text_col).to_pylist()]
            cut = [windows(t) for t in texts]
            got, starts = features([w for ws in cut for w in ws])
            logs = np.zeros((len(starts), len(langs)))
            if langs:
                for b in got:
                    logs += np.add.reduceat(m[b], starts, axis=0, dtype=np.float64)
            counts = [len(ws) for ws in cut]
            first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
            bare = np.add.reduceat(logs, first, axis=0)
            logs = bare + prior
            preds, scores = ["und"] * len(texts), [0.0] * len(texts)
            for i, t in enumerate(texts):
                if langs and any(map(str.isalpha, t)):
                    k = int(logs[i].argmax())
                    preds[i], scores[i] = langs[k], float(1 / np.exp(logs[i] - logs[i, k]).sum())
            more = []
            if fit:
                grams = np.add.reduceat(sum(np.add.reduceat((b < BUCKETS).astype(np.int64), starts) for b in got), first)
                own = [float(bare[i, langs.index(x)] / grams[i]) if x != "und" else 0.0 for i, x in enumerate(preds)]
                more = [pa.array(own, pa.float64()), pa.array(grams, pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64()), *more], schema.names)

    return df.mapInArrow(run, schema)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             mod: int = 4, rest: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, learnt from the
    labelled rows that aren't held out (see ``common.held_out``)."""
    out = held_out(df[id_col], mod, rest)
    langs, matrix = train(df.where(~out), text_col, lang_col)
    return predict(df.select(df[id_col].alias("doc_id"), out.alias("held_out"), df[text_col].alias("text")), langs, matrix).drop("text")


#: Texts with at least so many n-grams teach a language's band, if there are so many of them.
BAND_GRAMS, BAND_TEXTS = 300, 20
_STEPS = 64


def bands(fits: DataFrame, margin: float) -> dict[str, tuple[float, float]]:
    """For each language of ``fits`` (``lang``, ``fit``) the median fit and how far
    below it a text may lie: ``margin``, or 12 robust standard deviations if that is
    more. Fits are counted in steps of 1/64, so the driver gets a bounded table."""
    counts: dict[str, list] = {}
    for r in fits.groupBy("lang", F.round(F.col("fit") * _STEPS).cast("int").alias("step")).count().collect():
        counts.setdefault(r["lang"], []).append((r["step"] / _STEPS, r["count"]))

    def median(pairs):
        x, n = np.array(sorted(pairs)).T
        return float(x[np.searchsorted(np.cumsum(n), n.sum() / 2)])

    out = {}
    for lang, pairs in counts.items():
        if sum(n for _, n in pairs) >= BAND_TEXTS:
            m = median(pairs)
            out[lang] = m, max(margin, 12 * 1.4826 * median([(abs(x - m), n) for x, n in pairs]))
    return out


def keep_identified(df: DataFrame, least: float = 0.5, margin: float = 2.0, text_col: str = "text", lang_col: str = "lang",
                    id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose language can be told with probability ``least``
    or more, and whose n-grams are as likely in it as those of its training
    texts: their mean log-probability isn't below the language's median by more
    than ``margin`` (see ``bands``; for n below ``BAND_GRAMS`` n-grams by
    sqrt(BAND_GRAMS / n) times that). Posteriors saturate after a few words
    whatever the text is; this keeps out what is in none of the languages.
    (Junk that is a good part of a language's labelled rows is learnt with it.) A
    language with fewer than ``BAND_TEXTS`` longer training texts has no band; if no
    row is labelled, nothing can be told and all rows stay. Own columns only."""
    learnt = ~held_out(df[id_col], 4, 2)
    langs, matrix = train(df.where(learnt), text_col, lang_col)
    if not langs:
        return df
    names = "_lang_pred", "_lang_score", "_lang_fit"
    taught = predict(df.where(learnt & df[lang_col].isNotNull()).select(text_col), langs, matrix, text_col, *names)
    known = bands(taught.where((F.col("_lang_pred") != "und") & (F.col("_lang_fit_n") >= BAND_GRAMS))
                  .select(F.col("_lang_pred").alias("lang"), F.col("_lang_fit").alias("fit")), margin)
    found = predict(df, langs, matrix, text_col, *names)
    rows = [(x, *known[x]) for x in known]      # a row a language: their number is bounded by the matrix's size
    table = df.sparkSession.createDataFrame(rows, "_lang_pred string, _lang_median double, _lang_reach double")
    short = F.greatest(F.lit(1.0), F.sqrt(BAND_GRAMS / F.col("_lang_fit_n")))
    inside = F.col("_lang_fit") >= F.col("_lang_median") - F.col("_lang_reach") * short
    out = found.join(F.broadcast(table), "_lang_pred", "left")
    return out.where((F.col("_lang_pred") != "und") & (F.col("_lang_score") >= least) & F.coalesce(inside, F.lit(True))).select(*df.columns)
