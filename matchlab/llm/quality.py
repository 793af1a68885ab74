"""Quality rules: counts of words, symbols and repeats, and an n-gram
perplexity with bands for each language.

The language model tells every character apart and looks at the three before
it, one model for each value of the language column. It has two factors, both
interpolated modified Kneser-Ney models of order ``ORDER``: the symbol of
``letters`` after the symbols before it, and, for symbols that stand for many
characters, the character after the characters before it. After a character
that shares its symbol, the second model gives the next character alone,
whatever it is, so nothing is scored by merged characters.

Symbols: Tasks count the n-grams of all texts, Spark adds the counts up, and
the counts become sorted hash arrays: the 64-bit hash of (language, order,
n-gram), its discounted log-probability and its back-off weight. An alphabet
of 32 symbols bounds the arrays by 32^ORDER entries a language; their size is
bounded by the number of n-grams. The languages with the most text, up to
``LANGS`` and ``MODEL_MB``, are broadcast, and workers expand each once into a
table over all n-grams; documents of all other languages, however many, are
grouped by language, in parts of ``GROUP_GRAMS`` n-grams, with its counts. Both
ways give the same numbers.

Characters: their n-grams have no bounded number, so they are counted and
answered for as a table. Documents of one language make blocks; a block asks for
its distinct n-grams, Spark adds the blocks' counts up, gets each order from the
one above, and sends every block the log-probabilities it asked for.

A language's band comes from the log-perplexities of all its documents that
pass the basic rules: the quartiles, widened on both sides by ``FENCE`` times
their distance. A document outside its language's band is rejected.

Defined results: a null text is an empty one (no words, fails the basic
rules); a null language is a language of its own; texts without words have
no perplexity; a band of a single document keeps it; repeated rows count
repeatedly; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from matchlab.llm.align import squeeze, unsqueeze
from matchlab.llm.common import column, materialize, slices
from matchlab.llm.letters import MERGED, SYMBOLS, Sums, codes, grams, table
from matchlab.llm.minhash import Words, _mix

ORDER = 4
FENCE = 5.0
MODEL_MB = 256
LANGS = 32                  # tables of 4 MB that a worker keeps
GROUP_GRAMS = 1 << 23
HELD_GRAMS = 1 << 23        # n-grams that a counting task holds before it hands them on
BLOCK_EVENTS = 1 << 19      # character n-grams of the documents of a block, about
ANY = 63                    # instead of a symbol: any character may follow
SYMBOL_CHARS = "#*$%&|<>"   # fixed value
_PARTS = 16
_NONE = "\0"                # stands for a null language


def spelled(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and characters of the lower-cased text, each run of white space as one blank, after ORDER - 1 of white space."""
    c = codes(text.lower())
    s = table()[c]
    if len(s):
        keep = (s != 0) | np.concatenate([[True], s[:-1] != 0])
        c, s = c[keep], s[keep]
    return np.concatenate([np.zeros(ORDER - 1, np.uint8), s]), np.concatenate([np.full(ORDER - 1, 32, np.uint32), np.where(s, c, 32)])


def symbols(text: str) -> np.ndarray:
    return spelled(text)[0]


def events(s: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which places the symbols' model scores (those after ORDER - 1 characters
    that have a symbol of their own), and the n-grams of characters that the other
    model scores, as two numbers: symbol (or ANY) and two characters; two characters."""
    many = s >= MERGED
    before = many[2:-1] | many[1:-2] | many[:-3]
    at = np.flatnonzero(many[3:] | before)
    c = c.astype(np.int64)
    kind = np.where(before[at], ANY, s[at + 3]).astype(np.int64)
    return ~before, kind << 42 | c[at] << 21 | c[at + 1], c[at + 2] << 21 | c[at + 3]


def count_grams(df: DataFrame) -> DataFrame:
    """Counts of all n-grams of the rows (lang, text): a row (lang, part, codes,
    counts, total) for each language and part of its n-grams."""

    def count(batches):
        sums: dict[str, Sums] = {}
        for part in slices(batches):
            by: dict[str, list] = {}
            for lang, text in zip(column(part, "lang").to_pylist(), column(part, "text").to_pylist()):
                by.setdefault(lang, []).append(grams(symbols(text), ORDER)[ORDER - 1:])
            for lang, found in by.items():
                sums.setdefault(lang, Sums()).add(np.concatenate(found))
            if sum(len(s.codes) for s in sums.values()) > HELD_GRAMS:
                yield from packed(parts(sums))
                sums = {}
        yield from packed(parts(sums))

    def parts(sums):
        for lang, s in sums.items():
            home = s.codes % _PARTS
            for k in np.unique(home).tolist():
                yield lang, k, s.codes[home == k], s.counts[home == k]

    def add(batches):       # rows come sorted by language and part
        def totals():
            key, total = None, Sums()
            for b in batches:
                for lang, part, x, n, _ in zip(*(c.to_pylist() for c in b.columns)):
                    if key is not None and key != (lang, part):
                        yield *key, total.codes, total.counts
                        total = Sums()
                    key = lang, part
                    total.add(np.frombuffer(x, np.uint32), np.frombuffer(n, np.int64))
            if key is not None:
                yield *key, total.codes, total.counts

        yield from packed(totals())

    def packed(rows):
        held, size = [], 0
        for lang, part, x, n in rows:
            held.append((lang, part, x.tobytes(), n.tobytes(), int(n.sum())))
            size += x.nbytes + n.nbytes
            if size > 1 << 23 or len(held) == 1024:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    def batch(rows):
        kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["lang", "part", "codes", "counts", "total"])

    schema = "lang string, part int, codes binary, counts binary, total bigint"
    found = df.mapInArrow(count, schema).repartition(_PARTS, "lang", "part").sortWithinPartitions("lang", "part").mapInArrow(add, schema)
    return materialize(found, "quality-grams")


def joined(rows) -> Sums:
    """One language's counts from its (codes, counts) in binary form, which share no n-gram."""
    out = Sums()
    x, n = np.concatenate([np.frombuffer(x, np.uint32) for x, _ in rows]), np.concatenate([np.frombuffer(n, np.int64) for _, n in rows])
    order = np.argsort(x)
    out.codes, out.counts = x[order], n[order]
    return out


def model_bytes(n: int) -> int:
    """A bound of ``model_arrays`` for a language of ``n`` n-grams: at every order
    no more n-grams and contexts than that, or than there are."""
    return 24 * sum(min(n, SYMBOLS ** k) + min(n, SYMBOLS ** (k - 1)) for k in range(1, ORDER + 1))


def gram_hash(lang: int, order: int, code: np.ndarray) -> np.ndarray:
    x = np.uint64(lang) << np.uint64(40) | np.uint64(order) << np.uint64(32) | code.astype(np.uint64)
    x *= np.uint64(0x9E3779B97F4A7C15)     # odd: no two n-grams share a hash
    return x


def discounts(counts: np.ndarray) -> np.ndarray:
    """Kneser and Ney's D for counts of 0, 1, 2, 3 or more."""
    return discounts_of([float((counts == k).sum()) for k in range(1, 5)])


def discounts_of(n: list[float]) -> np.ndarray:
    """The same from how many counts are 1, 2, 3 and 4."""
    if not n[0] or not n[1]:
        return np.array([0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    d = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else 0.9 * (k + 1) for k in range(3)]
    return np.array([0, *(min(max(x, 0.1), 0.95 * (k + 1)) for k, x in enumerate(d))])


def model_arrays(sums: list[Sums]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, discounted log10-probabilities or -inf, log10 back-off weights."""
    keys, probs, weights = [], [], []
    for lang, s in enumerate(sums):
        code, count = s.codes, s.counts
        levels = {ORDER: (code, count)}
        for n in range(ORDER - 1, 0, -1):      # continuations: in how many n-grams of the order above
            code, count = np.unique(levels[n + 1][0] & np.uint32((1 << 5 * n) - 1), return_counts=True)
            levels[n] = code, count
        own: dict[int, dict] = {}
        for n, (code, count) in levels.items():
            d = discounts(count)[np.minimum(count, 3)]
            context, at = np.unique(code >> np.uint32(5), return_inverse=True)
            total = np.bincount(at, count).astype(float)
            own[n] = {"code": code, "p": (count - d) / total[at], "context": context, "weight": np.bincount(at, d) / total}
        for n, x in own.items():
            keys.append(gram_hash(lang, n, x["code"]))
            probs.append(x["p"])
            weights.append(np.full(len(x["code"]), np.nan))
            keys.append(gram_hash(lang, n + 16, x["context"]))     # back-off weight of a context of order n
            probs.append(np.full(len(x["context"]), np.nan))
            weights.append(x["weight"])
    if not keys:
        return np.empty(0, np.uint64), np.empty(0), np.empty(0)
    keys, probs, weights = map(np.concatenate, (keys, probs, weights))
    order = np.argsort(keys)
    return keys[order], probs[order], weights[order]


def expand(arrays, lang: int, code: np.ndarray | None = None) -> np.ndarray:
    """Natural log-probability of the last symbol of every n-gram of one language, or of those given."""
    keys, probs, weights = arrays

    def look(values, wanted, default):
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], default)

    code = np.arange(SYMBOLS ** ORDER, dtype=np.uint32) if code is None else code
    p = np.full(len(code), 1 / SYMBOLS)
    for n in range(1, ORDER + 1):
        gram = code & np.uint32((1 << 5 * n) - 1)
        p = look(probs, gram_hash(lang, n, gram), 0.0) + look(weights, gram_hash(lang, n + 16, gram >> np.uint32(5)), 1.0) * p
    return np.log(p).astype(np.float32)


_WORDS: list[Words] = []
_TABLES: dict[tuple, np.ndarray] = {}


def word_counts(text: str, words: Words) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    split = text.encode().split()
    n = len(split)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    marks = sum(map(text.count, SYMBOL_CHARS))
    dup = 0
    if "\n" in text:
        lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
        dup = len(lines) - len(set(lines))
    repeat = 0
    if n > 3:
        h = words(split)
        three = _mix(h[:-2], h[1:-1], h[2:])
        order = np.argsort(three, kind="stable")
        same = three[order[1:]] == three[order[:-1]]
        if same.any():
            twice = np.zeros(n - 2, bool)
            twice[order[1:][same]] = twice[order[:-1][same]] = True
            at = np.flatnonzero(twice)
            covered = np.zeros(n, bool)
            covered[at] = covered[at + 1] = covered[at + 2] = True
            repeat = int(covered.sum())
    return n, chars, marks, dup, repeat


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_grams", "logs", "block", "n_events", "events", "times"]


def basic_counts(texts: list[str]) -> np.ndarray:
    if not _WORDS:
        _WORDS.append(Words())
    return np.array([word_counts(t, _WORDS[0]) for t in texts], np.int64).reshape(len(texts), len(NAMES))


class Blocks:
    """Gathers documents with their character n-grams and hands them on in blocks of
    one language: a row for each document (``events``: gaps between the sorted places of its
    n-grams in the block's list, squeezed), and a row with ``n_words`` null for the block
    (its list and, as ``times``, how often each occurs)."""

    def __init__(self, name: str, doc_id: pa.DataType):
        self.name, self.closed, self.size, self.held = name, 0, 0, {}
        self.types = [doc_id, pa.string(), *[pa.int64()] * (len(NAMES) + 1), pa.float64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]

    def add(self, part, counts: np.ndarray, score):
        """``score(lang, grams)``: the symbols' log-probabilities."""
        for i, (doc, lang, text) in enumerate(zip(*(column(part, c).to_pylist() for c in ("doc_id", "lang", "text")))):
            n, logs, a, b = 0, None, np.empty(0, np.int64), np.empty(0, np.int64)
            if counts[i, 0]:
                s, c = spelled(text)
                own, a, b = events(s, c)
                n, logs = len(own), float(score(lang, grams(s, ORDER)[ORDER - 1:])[own].sum(dtype=np.float64))
            self.held.setdefault(lang, []).append(((doc, lang, *counts[i].tolist(), n, logs), a, b))
            self.size += len(a) + 16
            if self.size >= BLOCK_EVENTS:
                yield from self.close()

    def close(self):
        for lang, docs in self.held.items():
            block = f"{self.name}.{self.closed}"
            self.closed += 1
            a, b = (np.concatenate([d[k] for d in docs]) for k in (1, 2))
            sizes = np.array([len(d[1]) for d in docs])
            order = np.lexsort((b, a))
            new = np.ones(len(a), bool)
            new[1:] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
            places = np.empty(len(a), np.int64)
            places[order] = np.cumsum(new) - 1
            owned = np.sort(np.repeat(np.arange(len(docs)), sizes) << 32 | places) & 0xFFFFFFFF
            ends = np.cumsum(sizes)
            rows = [(*d[0], block, n, squeeze(np.diff(owned[e - n:e], prepend=0)), None) for d, n, e in zip(docs, sizes.tolist(), ends.tolist())]
            if len(a):
                a, b = a[order[new]], b[order[new]]
                rows.append((None, lang, *[None] * (len(NAMES) + 2), block, len(a), pa.compress(np.diff(a, prepend=0).tobytes() + b.tobytes(), codec="zstd", asbytes=True), squeeze(np.bincount(places))))
            for k in range(0, len(rows), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows[k:k + 2000]), self.types)], ["doc_id", "lang", *NAMES, *MORE])
        self.held, self.size = {}, 0


def measure(df: DataFrame, langs: list[str], arrays) -> DataFrame:
    """``doc_id, lang``, the basic counts, the symbols' part of the log-probability and
    the character n-grams (``Blocks``) of every row; rows of languages that aren't in
    ``langs`` have to be empty."""
    held = df.sparkSession.sparkContext.broadcast((dict(zip(langs, range(len(langs)))), arrays))
    model = uuid.uuid4().hex     # names the workers' expanded tables

    def run(batches):
        number, arrays = held.value
        blocks = None

        def score(lang, x):
            key = model, lang
            if key not in _TABLES:
                if len(_TABLES) >= LANGS:
                    _TABLES.clear()
                _TABLES[key] = expand(arrays, number[lang])
            return _TABLES[key][x]

        for part in slices(batches):
            blocks = blocks or Blocks(f"t{TaskContext.get().partitionId()}", column(part, "doc_id").type)
            yield from blocks.add(part, basic_counts(column(part, "text").to_pylist()), score)
        if blocks:
            yield from blocks.close()

    return df.mapInArrow(run, measure_schema(df))


def measure_schema(df: DataFrame) -> str:
    return (f"doc_id {dict(df.dtypes)['doc_id']}, lang string, " + ", ".join(f"{c} bigint" for c in NAMES)
            + ", n_grams bigint, logs double, block string, n_events bigint, events binary, times binary")


def measure_grouped(df: DataFrame, grams_of: DataFrame, sizes: DataFrame) -> DataFrame:
    """``measure`` for rows of any number of languages: a language's rows, in
    parts by id and text, meet its counts (``count_grams``) in groups."""
    spread = sizes.select("lang", F.ceil(F.col("total") / GROUP_GRAMS).cast("int").alias("n"))
    docs = df.join(spread, "lang").select(*df.columns, F.pmod(F.xxhash64("doc_id", "text"), F.col("n")).cast("int").alias("gid"))
    models = grams_of.join(spread, "lang").select("lang", "codes", "counts", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("gid"))

    def work(key: tuple, group: pa.Table, model: pa.Table) -> pa.Table:
        blocks = Blocks(f"g{key[1].as_py()}.{uuid.uuid4().hex}", group["doc_id"].type)
        out = []
        if group.num_rows:
            arrays = model_arrays([joined(list(zip(model["codes"].to_pylist(), model["counts"].to_pylist())))])
            whole = expand(arrays, 0) if pa.compute.sum(pa.compute.binary_length(group["text"])).as_py() > SYMBOLS ** ORDER else None

        def score(_, x):
            if whole is not None:
                return whole[x]
            code, at = np.unique(x, return_inverse=True)       # only the text's own n-grams
            return expand(arrays, 0, code)[at]

        for part in slices(group.to_batches()):
            out += blocks.add(part, basic_counts(column(part, "text").to_pylist()), score)
        out += blocks.close()
        return pa.Table.from_batches(out, pa.schema(list(zip(["doc_id", "lang", *NAMES, *MORE], blocks.types))))

    return docs.groupBy("lang", "gid").cogroup(models.groupBy("lang", "gid")).applyInArrow(work, measure_schema(df))


def asked(rows: DataFrame) -> DataFrame:
    """``block, lang, a, b, n``: how often each character n-gram occurs in a block."""
    def work(batches):
        for batch in batches:
            for block, lang, n, listed, times in zip(*(column(batch, c).to_pylist() for c in ("block", "lang", "n_events", "events", "times"))):
                ab = np.frombuffer(pa.decompress(listed, 16 * n, codec="zstd", asbytes=True), np.int64).reshape(2, n)
                a, b, times = np.cumsum(ab[0]), ab[1], unsqueeze(times, n)
                for k in range(0, n, 1 << 16):
                    own = slice(k, k + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array([block] * len(a[own])), pa.array([lang] * len(a[own])), pa.array(a[own]), pa.array(b[own]), pa.array(times[own])],
                                                     ["block", "lang", "a", "b", "n"])

    return rows.where("n_words IS NULL").select("block", "lang", "n_events", "events", "times").mapInArrow(work, "block string, lang string, a bigint, b bigint, n bigint")


def letter_model(counts: DataFrame) -> DataFrame:
    """``lang, a, b, log_p`` (natural) of all character n-grams, from their counts
    (lang, a, b, n). Each order counts the n-grams of the order above that end in its own.
    All windows and joins are by n-grams less one character, so no group has more rows
    than there are characters. Discounts are shared by the languages."""
    n4 = counts.select("lang", "a", "b", "n", F.shiftright("a", 42).alias("k"), F.col("a").bitwiseAND((1 << 21) - 1).alias("c2"),
                       F.shiftright("b", 21).alias("c1"), F.col("b").bitwiseAND((1 << 21) - 1).alias("c"))
    keys = [["lang", "k", "c"], ["lang", "k", "c1", "c"], ["lang", "k", "c2", "c1", "c"]]
    n3 = n4.groupBy(*keys[2]).agg(F.count(F.lit(1)).alias("n"))
    n2 = n3.groupBy(*keys[1]).agg(F.count(F.lit(1)).alias("n"))
    n1 = n2.groupBy(*keys[0]).agg(F.count(F.lit(1)).alias("n"))
    few = [x.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in range(1, 5)]).first() for x in (n1, n2, n3, n4)]

    def level(grams: DataFrame, context: list[str], of: list[float], below: Column) -> DataFrame:
        d = F.when(F.col("n") == 1, F.lit(float(of[1]))).when(F.col("n") == 2, F.lit(float(of[2]))).otherwise(F.lit(float(of[3])))
        w = Window.partitionBy(*context)
        # the discounts' sum from counts, so that it doesn't depend on the order of rows
        spare = sum(F.sum((F.least("n", F.lit(3)) == k).cast("bigint")).over(w) * float(of[k]) for k in (1, 2, 3))
        return grams.withColumn("_p", (F.col("n") - d) / F.sum("n").over(w)).withColumn("_w", spare / F.sum("n").over(w)).withColumn(
            "_v", F.count(F.lit(1)).over(w)).withColumn("p", F.col("_p") + F.col("_w") * below).drop("_p", "_w", "_v")

    found = level(n1, ["lang", "k"], discounts_of(list(few[0])), 1 / (F.col("_v") + 1))
    for grams_of, key, context, few_of in ((n2, keys[0], ["lang", "k", "c1"], few[1]), (n3, keys[1], ["lang", "k", "c2", "c1"], few[2]), (n4, keys[2], ["lang", "a", "c1"], few[3])):
        lower = found.select(*key, F.col("p").alias("q"))
        found = level(grams_of.join(lower, key), context, discounts_of(list(few_of)), F.col("q")).drop("q")
    return found.select("lang", "a", "b", F.log("p").alias("log_p"))


def perplexities(rows: DataFrame) -> DataFrame:
    """``doc_id, lang``, the basic counts and ``log_ppl``, from what ``measure`` tells."""
    ask = asked(rows)
    counts = materialize(ask.groupBy("lang", "a", "b").agg(F.sum("n").alias("n")), "quality-letters")
    answers = ask.select("block", "lang", "a", "b").join(letter_model(counts), ["lang", "a", "b"]).select("block", "a", "b", "log_p")
    told = ["doc_id", "lang", *NAMES]

    def gather(known: pa.Table, docs: pa.Table) -> pa.Table:
        logs = known["log_p"].to_numpy()[np.lexsort((known["b"].to_numpy(), known["a"].to_numpy()))]
        out = [None if x is None else -(x + float(logs[np.cumsum(unsqueeze(listed, size))].sum())) / n
               for n, x, size, listed in zip(*(docs[c].to_pylist() for c in ("n_grams", "logs", "n_events", "events")))]
        return pa.table([*(docs[c] for c in told), pa.array(out, pa.float64())], names=[*told, "log_ppl"])

    kinds = dict(rows.dtypes)
    docs = rows.where("n_words IS NOT NULL").select(*told, "n_grams", "logs", "block", "n_events", "events")
    return answers.groupBy("block").cogroup(docs.groupBy("block")).applyInArrow(gather, ", ".join(f"{c} {kinds[c]}" for c in told) + ", log_ppl double")


def judge(df: DataFrame, least_words: int = 50, most_repeat: int = 50, fence: float = FENCE,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, lang, log_ppl, low, high, kept`` of every row."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit(_NONE)).alias("lang"))
    counts = count_grams(docs.where("text != ''").select("lang", "text"))
    sizes = counts.groupBy("lang").agg(F.sum(F.expr("length(codes) div 4")).alias("n"), F.sum("total").alias("total"))
    langs, size, rest = [], 0, False
    for r in sizes.orderBy(F.desc("total"), "lang").limit(LANGS + 1).collect():
        size += model_bytes(r.n)
        rest = rest or len(langs) == LANGS or size > MODEL_MB << 20
        if not rest:
            langs.append(r.lang)
    found: dict[str, list] = {x: [] for x in langs}
    for r in counts.where(F.col("lang").isin(langs)).toLocalIterator():      # at most MODEL_MB
        found[r.lang].append((r.codes, r.counts))
    langs.sort()
    arrays = model_arrays([joined(found[x]) for x in langs])
    near = F.col("lang").isin(langs)
    if rest:
        far = measure_grouped(docs.where(~near & (F.col("text") != "")), counts.where(~near), sizes.where(~near))
        rows = measure(docs.where(near | (F.col("text") == "")), langs, arrays).union(far)
    else:
        rows = measure(docs, langs, arrays)
    rows = materialize(perplexities(materialize(rows, "quality-blocks")), "quality").withColumn(
        "base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeat * F.col("n_words")))
    quarter = F.percentile_approx("log_ppl", [0.25, 0.75], 10000)
    bands = rows.where(~F.col("base_failed")).groupBy("lang").agg(quarter.alias("q")).select(
        "lang", (F.col("q")[0] - fence * (F.col("q")[1] - F.col("q")[0])).alias("low"), (F.col("q")[1] + fence * (F.col("q")[1] - F.col("q")[0])).alias("high"))
    return rows.join(bands, "lang", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("log_ppl").between(F.col("low"), F.col("high")), F.lit(False))).withColumn(
        "lang", F.nullif("lang", F.lit(_NONE))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lang", "log_ppl", "low", "high", "kept")
