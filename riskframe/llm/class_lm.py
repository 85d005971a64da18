"""Brown class-based bigram language model: classes by exchange clustering.

P(word | word before) = P(class | class before) P(word | class). Clustering
has two parts. The exchange algorithm finds the classes: it moves one unit
at a time to the class that raises the likelihood of the class bigrams
most, in sweeps until nothing moves. Its units are the ``WORDS`` most
frequent words and, for all others, their forms (the last three bytes,
hashed into ``FORMS``), so its bigram table is bounded. Then every other
word of the training text, however rare, leaves its form and becomes a unit
of its own: one distributed step gives it the class under which the contexts
of all its occurrences are likeliest. The classes of words are a distributed
table, as their counts are. Class sizes and transitions are counted anew
from the words' own classes. Only words that training has not seen, which
have no contexts, keep the class of their form.

Smoothing: class transitions are interpolated with class frequencies;
words of a class are discounted by D = n1 / (n1 + 2 n2), and the mass that
frees is spread evenly over the unseen words of the class, whose number is
estimated (Chao1: n1 (n1 - 1) / 2 (n2 + 1) in all, shared by the classes'
known words; n1 and n2 count the words seen once and twice).

Words are counted in Arrow batches, merged per task before the shuffle. In
scoring, up to ``HEAD`` of the most frequent words are looked up in a table sent
to the tasks (24 bytes a word); only the others are joined with the classes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import saved, small_batches
from riskframe.llm.text import U64, Words, mix, signed, slices, words

WORDS = 512
FORMS = 512
CLASSES = 48
SWEEPS = 20
HEAD = 200_000
MERGE = 1 << 20      # distinct words, or occurrences in context, that a task holds before it passes them on
PRIOR = 50.0         # weight of class frequencies in a transition

_END = WORDS + FORMS  # the unit of the end of a text; it also comes before the first word
_UNITS = _END + 1


def _forms(w: Words) -> np.ndarray:
    """Form unit of each word: its last three bytes, A-Z lowered."""
    low = np.arange(256, dtype=np.uint64)
    low[0x41:0x5B] += U64(32)
    code = np.zeros(len(w.start), U64)
    for back in (1, 2, 3):
        at = w.end - back
        code = code * U64(256) + np.where(at >= w.start, low[w.data[np.maximum(at, 0)]], U64(0))
    return WORDS + (mix(code) % U64(FORMS)).astype(np.int64)


def _keys(w: Words) -> np.ndarray:
    """Word hashes with the form in place of the low bits, so that a counted word tells its form."""
    return (w.hash & ~U64(FORMS - 1)) | (_forms(w) - WORDS).astype(U64)


class _Lookup:
    """Positions of 64-bit keys in a sorted array, -1 where absent."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(keys >> U64(42)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1)
        if len(self.keys):
            at = np.flatnonzero(self.seen[(h >> U64(42)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
            real = self.keys[k] == h[at]
            out[at[real]] = k[real]
        return out


def _units(keys: np.ndarray, frequent: _Lookup, unit: np.ndarray) -> np.ndarray:
    k = frequent.find(keys)
    return np.where(k >= 0, unit[k] if len(unit) else 0, WORDS + (keys & U64(FORMS - 1)).astype(np.int64))


def _with_ends(values: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of all texts with an end after each, and the new offsets."""
    n = len(offsets) - 1
    out = np.full(len(values) + n, end)
    out[np.arange(len(values)) + np.repeat(np.arange(n), np.diff(offsets))] = values
    return out, offsets + np.arange(n + 1)


def _merged(batches: Iterator[pa.RecordBatch], keys_of: Callable, names: list[str]) -> Iterator[pa.RecordBatch]:
    """(key, count) of a task's texts, merged in memory up to ``MERGE`` distinct keys."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=names)

    for batch in batches:
        for lo, hi in slices(batch.column(0)):
            k, c = np.unique(keys_of(batch.column(0).slice(lo, hi - lo)), return_counts=True)
            both, where = np.unique(np.concatenate((keys, k)), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, c)), len(both)).astype(np.int64)
            keys = both
            if len(keys) > MERGE:
                yield out()
                keys, counts = keys[:0], counts[:0]
    if len(keys):
        yield out()


def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit from the (units, units) bigram counts; the last unit keeps
    the last class to itself. Raises sum f(N(a, b)) - sum f(N(a, .)) - sum f(N(., b)),
    f(x) = x ln x, the part of the likelihood that depends on the classes."""
    n = len(counts)
    counts = counts.astype(float)
    f = lambda x: x * np.log(np.maximum(x, 1.0))  # noqa: E731  counts are whole: f(0) = f(1) = 0
    size = counts.sum(axis=1) + counts.sum(axis=0)
    order = np.argsort(-size[:-1], kind="stable")
    own = np.empty(n, np.int64)
    own[order] = np.arange(n - 1) % (classes - 1)
    own[-1] = classes - 1
    member = np.zeros((n, classes))
    member[np.arange(n), own] = 1
    right, left = counts @ member, counts.T @ member  # of unit u: counts before / after each class
    g = member.T @ right
    for _ in range(sweeps):
        moved = 0
        for u in order:
            if not size[u]:
                continue
            a, self_count = own[u], counts[u, u]
            r, l = right[u].copy(), left[u].copy()
            r[a] -= self_count
            l[a] -= self_count
            g[a] -= r
            g[:, a] -= l
            g[a, a] -= self_count
            fg = f(g)
            # Tokens of the other classes stay what they were, next to u or not.
            rows, cols, total_r, total_l = g.sum(axis=1) + l, g.sum(axis=0) + r, r.sum() + self_count, l.sum() + self_count
            gain = (f(g + r[None, :]) - fg).sum(axis=1) + (f(g + l[:, None]) - fg).sum(axis=0)
            d = np.diagonal(g)
            gain += f(d + r + l + self_count) - f(d + r) - f(d + l) + f(d)
            gain -= f(rows + total_r) - f(rows) + f(cols + total_l) - f(cols)
            gain[-1] = -np.inf
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            g[b] += r
            g[:, b] += l
            g[b, b] += self_count
            if b != a:
                own[u] = b
                moved += 1
                right[:, a] -= counts[:, u]
                right[:, b] += counts[:, u]
                left[:, a] -= counts[u]
                left[:, b] += counts[u]
        if not moved:
            break
    return own


def _transitions(g: np.ndarray) -> np.ndarray:
    """log10 P(class | class before) from the counts of class bigrams."""
    share = (g.sum(axis=0) + 1) / (g.sum() + CLASSES)
    return np.log10((g + PRIOR * share[None, :]) / (g.sum(axis=1, keepdims=True) + PRIOR))


def _contexts(batches: Iterator[pa.RecordBatch], frequent: _Lookup, unit: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(word, seen) of the texts' words that are no units: ``seen`` is the number of
    occurrences times CLASSES^2, plus the class before times CLASSES, plus the class after."""
    held, size = [], 0

    def out() -> pa.RecordBatch:
        word, around = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((around, word))
        word, around = word[order], around[order]
        new = np.ones(len(word), bool)
        new[1:] = (word[1:] != word[:-1]) | (around[1:] != around[:-1])
        first = np.flatnonzero(new)
        seen = np.diff(np.append(first, len(word))) * CLASSES**2 + around[first]
        return pa.RecordBatch.from_arrays([pa.array(signed(word[first])), pa.array(seen)], names=["word", "seen"])

    for batch in batches:
        for lo, hi in slices(batch.column(0)):
            w = words(batch.column(0).slice(lo, hi - lo))
            keys = _keys(w)
            seq, _ = _with_ends(own[_units(keys, frequent, unit)], w.offsets, CLASSES - 1)
            rest = np.flatnonzero(frequent.find(keys) < 0)
            at = rest + np.searchsorted(w.offsets, rest, side="right") - 1  # an end follows every text before
            before = np.where(at > 0, seq[at - 1], CLASSES - 1)
            held.append((keys[rest], before * CLASSES + seq[at + 1]))
            size += len(rest)
            if size >= MERGE:
                yield out()
                held, size = [], 0
    if size:
        yield out()


def _likeliest(batches: Iterator[pa.RecordBatch], before: np.ndarray, after: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(word, n, class) from rows (word, seen) sorted by word: the class that maximises the sum
    over occurrences of log10 P(class | class before) P(class after | class) / size(class)."""
    score = lambda seen: ((seen // CLASSES**2)[:, None] * (
        before[seen // CLASSES % CLASSES] + after[seen % CLASSES] - np.log10(np.maximum(size, 1))))
    last, last_n, last_score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, CLASSES))

    def out(word: np.ndarray, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        best = total[:, :-1].argmax(axis=1)  # the last class is the end's
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(n), pa.array(best.astype(np.int32))], names=["word", "n", "class"])

    for batch in batches:
        if not batch.num_rows:
            continue
        seen = batch.column(1).to_numpy()
        word = np.concatenate((last, batch.column(0).to_numpy()))
        n, total = np.concatenate((last_n, seen // CLASSES**2)), np.concatenate((last_score, score(seen)))
        first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
        word, n, total = word[first], np.add.reduceat(n, first), np.add.reduceat(total, first)
        last, last_n, last_score = word[-1:], n[-1:], total[-1:]  # its rows may go on in the next batch
        yield out(word[:-1], n[:-1], total[:-1])
    if len(last):
        yield out(last, last_n, last_score)


@dataclass
class Model:
    classes: DataFrame        # word bigint, n bigint, class int: all training words
    tokens: int               # N, ends included
    distinct: int             # V, the end included
    form: np.ndarray          # class of each form, for words that training has not seen
    size: np.ndarray          # training tokens of each class
    known: np.ndarray         # training words of each class
    discount: float
    missing: float            # estimated number of words that training has not seen
    head: np.ndarray          # sorted hashes of the most frequent words
    head_counts: np.ndarray
    head_classes: np.ndarray

    def seen(self, n: Column, size: Column) -> Column:
        return F.log10((n - self.discount) / size)

    def unseen(self) -> np.ndarray:
        """log10 of an unseen word's probability in each class."""
        mass = np.where(self.size > 0, self.discount * self.known / np.maximum(self.size, 1), 1.0)
        share = (self.known + 1) / (self.known + 1).sum()
        return np.log10(np.maximum(mass, 1e-9) / np.maximum(self.missing * share, 1))


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of the largest ``n``, up to ``most`` of them: all from a bound upwards, which is
    read off at most 4,100 counts, so that no rows are sorted together in one task."""
    step = F.floor(F.log2("n") * 64)
    bound, total = None, 0
    for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect():
        total += r["rows"]
        if total > most:
            break
        bound = r["step"]
    return counts.filter(step >= bound if bound is not None else F.lit(False))


def train(texts: DataFrame) -> Model:
    """Counts and classes from the ``text`` column of all rows (null = empty)."""
    spark = texts.sparkSession
    texts = texts.select("text")

    def word_keys(column: pa.Array) -> np.ndarray:
        return signed(_keys(words(column)))

    rows = texts.mapInArrow(lambda b: _merged(b, word_keys, ["word", "n"]), "word bigint, n bigint")
    counts = saved(rows.groupBy("word").agg(F.sum("n").alias("n")), "words")
    n_docs = texts.count()
    tokens, distinct, ones, twos = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    top = counts.orderBy(F.desc("n"), "word").limit(WORDS).toArrow()
    first = top.column("word").to_numpy().view(U64)
    order = np.argsort(first)
    frequent, unit = first[order], order
    shared = spark.sparkContext.broadcast((frequent, unit))

    def pair_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, unit = shared.value
        lookup = _Lookup(frequent)
        total = np.zeros(_UNITS * _UNITS, np.int64)
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                w = words(batch.column(0).slice(lo, hi - lo))
                u, _ = _with_ends(_units(_keys(w), lookup, unit), w.offsets, _END)
                total += np.bincount(np.concatenate(([_END], u[:-1])) * _UNITS + u, minlength=len(total)) if len(u) else 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["pair", "n"])

    pairs = texts.mapInArrow(pair_keys, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    bigrams = np.zeros(_UNITS * _UNITS, np.int64)  # at most units^2 rows
    bigrams[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    bigrams = bigrams.reshape(_UNITS, _UNITS)
    own = exchange(bigrams)
    member = np.zeros((_UNITS, CLASSES))
    member[np.arange(_UNITS), own] = 1
    g = member.T @ bigrams @ member
    step, tokens_of = _transitions(g), g.sum(axis=0)
    around = (texts.mapInArrow(lambda b: _contexts(b, _Lookup(shared.value[0]), shared.value[1], own), "word bigint, seen bigint")
              .repartition("word").sortWithinPartitions("word", "seen"))
    others = around.mapInArrow(lambda b: _likeliest(b, step, step.T, tokens_of), "word bigint, n bigint, class int")
    units = spark.createDataFrame(
        [(int(w), int(n), int(c)) for w, n, c in zip(signed(first), top.column("n").to_numpy(), own[:len(first)])], others.schema)
    classes = saved(others.unionByName(units), "classes")
    size, known = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in classes.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():  # a row a class
        size[r["class"]], known[r["class"]] = r["n"], r["words"]
    size[CLASSES - 1] = n_docs
    head = _most_frequent(classes, HEAD).toArrow()
    hashes = head.column("word").to_numpy().view(U64)
    order = np.argsort(hashes)
    return Model(classes, int(tokens) + n_docs, int(distinct) + (1 if n_docs else 0), own[WORDS:_END], size, known,
                 ones / (ones + 2 * twos) if ones and twos else 0.5,
                 ones * (ones - 1) / (2 * (twos + 1)),
                 hashes[order], head.column("n").to_numpy()[order], head.column("class").to_numpy()[order])


_PARTS = ("id bigint, version bigint, n_tokens bigint, n_known bigint, base double, score double, "
          "path binary, tail array<struct<word:bigint,place:int>>")
_PLACE = 64  # a place in a text times this, plus the class of the word there: one number
_WALKS = "id bigint, n_tokens bigint, n_known bigint, base double, score double, path binary"


def _paths(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a binary column without nulls, and their offsets."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[o[0]:o[-1]], o - o[0]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data.astype(np.uint8))]).cast(pa.binary())


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths with the joined words' classes (column ``places``, null where there are none) put in."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, edges = _paths(batch.column(5))
        path = path.copy()
        places = batch.column(6)
        packed = places.flatten().to_numpy(zero_copy_only=False)
        if len(packed):
            row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(places), 0).to_numpy())
            path[edges[row] + packed // _PLACE] = packed % _PLACE
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], _binary(path, edges)], names=batch.schema.names[:6])


def _walk_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, n) of class bigrams on the paths (first column); every path ends with the end's class."""
    total = np.zeros(CLASSES * CLASSES, np.int64)
    for batch in batches:
        if batch.num_rows:
            path = _paths(batch.column(0))[0].astype(np.int64)
            total += np.bincount(np.concatenate(([CLASSES - 1], path[:-1])) * CLASSES + path, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["pair", "n"])


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows for which ``learn`` (over the column ``id``) is true;
    rows without id are scored and not learned from. A null or empty text is
    one end token. Equal rows get equal scores. Without training rows every
    word is unseen. Very long texts are scored whole; an empty table gives no
    rows. Where no word occurs twice, or none once, half a count is kept for
    unseen words, so every score is finite. Other columns are not looked at.
    """
    walks, model = walked(docs, learn, id_col, text_col)
    step = _transitions(transitions(walks.filter(learn)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            path, edges = _paths(batch.column(5))
            path = path.astype(np.int64)
            steps = step[np.concatenate(([CLASSES - 1], path[:-1])), path]
            total = batch.column(4).to_numpy() + np.add.reduceat(steps, edges[:-1])  # no path is empty
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(total)], names=batch.schema.names[:5])

    found = walks.mapInArrow(run, "id bigint, n_tokens bigint, n_known bigint, base double, score double")
    return found.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                        F.col("base").alias("base_score"), "score")


def transitions(walks: DataFrame) -> np.ndarray:
    """Counts of (class before, class) over all paths."""
    g = np.zeros(CLASSES * CLASSES)
    pairs = walks.select("path").mapInArrow(_walk_counts, "pair bigint, n bigint")
    for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most CLASSES^2 rows
        g[r["pair"]] = r["n"]
    return g.reshape(CLASSES, CLASSES)


def walked(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Model]:
    """Per row of ``docs``: id, n_tokens, n_known, base, the words' log10 probability within
    their classes (score), and the classes of its tokens as bytes (path); and the model."""
    spark = docs.sparkSession
    base = small_batches(docs).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    model = train(base.filter(learn))
    shared = spark.sparkContext.broadcast(model_parts(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        head = _Lookup(m["head"])
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                w = words(batch.column(2).slice(lo, hi - lo))
                n = hi - lo
                keys = _keys(w)
                at = head.find(keys)
                near = at >= 0
                c = np.zeros(len(keys), np.int64)
                c[near] = m["head_classes"][at[near]]
                path, edges = _with_ends(c, w.offsets, CLASSES - 1)
                text = np.repeat(np.arange(n), np.diff(w.offsets))
                count = m["head_counts"][at[near]]
                low = np.log10((count + 1) / m["total"])
                emit = np.log10((count - m["discount"]) / m["size"][c[near]])
                known = np.bincount(text[near], minlength=n)
                base = np.bincount(text[near], low, n) + m["end_base"]
                score = np.bincount(text[near], emit, n).astype(float)  # of nothing, it counts in whole numbers
                far = np.flatnonzero(~near)
                tail = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(text[far], np.arange(n + 1)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(signed(keys[far])), pa.array(far - w.offsets[text[far]], pa.int32())], ["word", "place"]))
                part = batch.slice(lo, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.diff(edges), pa.int64()), pa.array(known + m["end_known"], pa.int64()),
                     pa.array(base), pa.array(score), _binary(path, edges), tail],
                    names=["id", "version", "n_tokens", "n_known", "base", "score", "path", "tail"])

    versioned = base.select("id", F.xxhash64("id", "text").alias("version"), "text")
    parts = saved(versioned.mapInArrow(run, _PARTS), "parts")
    total = float(model.tokens + model.distinct + 1)
    table = lambda x, at: F.element_at(F.array(*[F.lit(v) for v in x.tolist()]), at + 1)
    n = F.coalesce("n", F.lit(0))
    rest = (parts.select("version", F.explode("tail").alias("t"))
            .join(model.classes, F.col("t.word") == F.col("word"), "left")
            .select("version", "t", n.alias("n"), F.coalesce(
                "class", table(model.form, F.col("t.word").bitwiseAND(FORMS - 1).cast("int"))).alias("class"))
            .groupBy("version").agg(
                F.count_if(F.col("n") > 0).alias("known"),
                F.sum(F.log10((F.col("n") + 1) / F.lit(total))).alias("base"),
                F.sum(F.when(F.col("n") > 0, model.seen(F.col("n"), table(np.maximum(model.size, 1), F.col("class"))))
                      .otherwise(table(model.unseen(), F.col("class")))).alias("score"),
                F.collect_list(F.col("t.place").cast("bigint") * _PLACE + F.col("class")).alias("places")))
    # Equal rows share a version: what they sum to is divided by their number; their places say the same.
    r = rest.join(parts.groupBy("version").agg(F.count("*").alias("rows")), "version").alias("r")
    p = parts.drop("tail").alias("p")
    add = lambda a: F.coalesce(F.col(f"r.{a}") / F.col("r.rows"), F.lit(0))
    whole = p.join(r, "version", "left").select(
        "id", "n_tokens", (F.col("n_known") + add("known")).cast("long").alias("n_known"), (F.col("p.base") + add("base")).alias("base"),
        (F.col("p.score") + add("score")).alias("score"), "path", "places")
    return saved(whole.mapInArrow(_filled, _WALKS), "walks"), model


def model_parts(model: Model) -> dict:
    """What a scoring task needs, in plain arrays."""
    ends = model.size[CLASSES - 1] if model.tokens else 0
    total = float(model.tokens + model.distinct + 1)
    return {"size": np.maximum(model.size, 1), "head": model.head, "head_counts": model.head_counts, "head_classes": model.head_classes,
            "discount": model.discount, "total": total, "end_base": float(np.log10((ends + 1) / total)), "end_known": int(ends > 0)}


def held_out(key: Column) -> Column:
    """Rows left out of training: crc32 of the id as text, mod 7, is 2."""
    return (F.crc32(key.cast("string")) % 7) == 2


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` with the seventh fold held out, and ``held_out`` (null without id)."""
    found = score(docs, ~held_out(F.col("id")), id_col, text_col)
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
