"""Scoring texts by prediction by partial matching, beside a word unigram base.

A text is lower-cased (A-Z) and read as words, each followed by one space, but the last by an end
symbol, byte 0x0A, which no word holds; its log10 probability is the sum over these bytes.  The model is a
trie of byte contexts up to ``order``, learned from the training texts.  A byte seen c times after a
context with T bytes, D of them different, has probability (2c - 1) / 2T there; the rest, D / 2T,
escapes to the next shorter context, where the bytes seen after the longer one are excluded from c, T and D.
Below the empty context the bytes not seen at all share what is left.  A context without training bytes
is passed over.  Since what follows a context also follows its shorter ones, the excluded part of a
context is a sum that belongs to the next longer one, so the trie is a table per order.

Nothing is broadcast that grows.  Tasks cut their rows into blocks of about ``block_bytes``, and each block
asks for its different contexts-with-byte and its different words: sorted keys and training counts, dealt over
shards by hash and packed.  There is a shard for every ``shard_bytes`` of text, so a shard sees an even part of the keys,
and a key only once a block, however frequent.  Shards add up the counts, the trie is built from their sums with joins,
and each shard answers each block in the order asked; answers and the block's texts (compressed) then meet by block.

Defined cases: a null text is the empty text (the end alone); a null id counts as the empty id for
the split; repeated rows are scored each and count each in training; without training texts every byte has
probability 1/256; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rewardloom.llm.common import column_or_null, materialize, materialize_by

SYMBOLS = 256
TEXTS, GRAMS, WORDS = 0, 1, 2
_KIND = "kind int, block long, shard int, keys binary, counts binary"
_ROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_DOCS = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.binary())])
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("shard", pa.int32()), ("known", pa.int64()), ("values", pa.binary())])


def _squeeze(a: np.ndarray) -> bytes:
    """Numbers by byte plane, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(3).compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _codes(texts: list[bytes], order: int):
    """Of some texts at a time: the context of ``order`` bytes and the byte as one integer for every byte of each and
    its end, and where each text begins.  Before a text stand spaces."""
    lead, i = b" " * order, 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < 1 << 21):
            size += len(texts[j])
            j += 1
        part = texts[i:j]
        whole = np.frombuffer(b"".join([lead + x + b"\n" for x in part]), np.uint8)
        sizes = np.array([len(x) + 1 for x in part])
        begins = np.cumsum(sizes) - sizes
        code = np.zeros(len(whole) - order, np.int64)
        for k in range(order + 1):
            code <<= 8
            code |= whole[k:len(whole) - order + k]
        keep = np.ones(len(code), bool)
        for k in range(order):        # windows that end in the spaces before the next text
            keep[begins[1:] + np.arange(1, len(part)) * order - order + k] = False
        yield code[keep], begins, sizes, i, j
        i = j


def _distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, each value once.  (Without counts, np.unique goes by a hash table, several times slower here.)"""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _grams(texts: list[bytes], order: int) -> np.ndarray:
    return _distinct(np.concatenate([_distinct(code) for code, *_ in _codes(texts, order)]))


def _gram_shards(grams: np.ndarray, shards: int) -> np.ndarray:
    return ((grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(shards)).astype(np.int32)


def _words(texts: list[bytes]) -> list[bytes]:
    """The block's different words, sorted (neighbours alike compress well)."""
    found: set[bytes] = set()
    for text in texts:
        found.update(text.split())
    return sorted(found)


def _word_shards(words: list[bytes], shards: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % shards for w in words), np.int32, len(words))


def _asked(batches, order: int, block_bytes: int, shards: int, fold: int):
    part, number = TaskContext.get().partitionId(), 0
    ids, held, texts, size = [], [], [], 0

    def block():
        at, rows = (part << 24) + number, []
        batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held), pa.array(texts, pa.binary())], schema=_DOCS)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as out:
            out.write_batch(batch)
        rows.append((TEXTS, at, 0, sink.getvalue().to_pybytes(), None))
        keys, counts = [], []
        learn = ~np.array(held)
        for code, _, sizes, i, j in _codes(texts, order):
            key, n = np.unique(code * 2 + np.repeat(learn[i:j], sizes), return_counts=True)
            keys.append(key)
            counts.append(n)
        key = np.concatenate(keys)
        by = np.argsort(key, kind="stable")
        key, n = key[by], np.concatenate(counts)[by]
        gram, first = np.unique(key >> 1, return_index=True)
        n = np.add.reduceat(np.where(key & 1, n, 0), first).astype(np.uint32)
        shard = _gram_shards(gram, shards)
        for s in np.unique(shard).tolist():
            mine = shard == s
            rows.append((GRAMS, at, s, _squeeze(np.diff(gram[mine], prepend=np.int64(0))), _squeeze(n[mine])))
        words, seen = _words(texts), Counter()
        for text, out in zip(texts, held):
            if not out:
                seen.update(text.split())
        shard = _word_shards(words, shards)
        by = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[by], np.arange(shards + 1))
        for s in np.unique(shard).tolist():
            mine = [words[k] for k in by[cut[s]:cut[s + 1]]]
            rows.append((WORDS, at, s, zstandard.ZstdCompressor(3).compress(b" ".join(mine)),
                         _squeeze(np.array([seen[w] for w in mine], np.uint32))))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = b" ".join((text or "").encode().lower().split())
            ids.append(doc)
            texts.append(text)
            held.append(zlib.crc32(b"" if doc is None else str(doc).encode()) % fold == 0)
            size += len(text) + order + 1
            if size >= block_bytes:
                yield from block()
                number, size, ids, held, texts = number + 1, 0, [], [], []
    if texts:
        yield from block()


def _gram_keys(row: dict) -> np.ndarray:
    return np.cumsum(_expand(row["keys"], np.int64))


def _gram_sums(t: pa.Table) -> pa.Table:
    """A shard's keys with their training counts over all blocks."""
    gram, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for row in t.to_pylist():
        both = np.concatenate([gram, _gram_keys(row)])
        n = np.concatenate([total, _expand(row["counts"], np.uint32).astype(np.int64)])
        gram, place = np.unique(both, return_inverse=True)
        total = np.bincount(place, n, len(gram)).astype(np.int64)
    return pa.table({"shard": pa.array(np.full(len(gram), t.column("shard")[0].as_py(), np.int32)), "gram": gram, "c": total})


def _answers(rows: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ANSWER)], schema=_ANSWER) if rows else _ANSWER.empty_table()


def _gram_answers(asked: pa.Table, known: pa.Table) -> pa.Table:
    gram, logp = known.column("gram").to_numpy(), known.column("logp").to_numpy()
    by = np.argsort(gram)
    gram, logp = gram[by], logp[by].astype(np.float32)
    return _answers([(r["block"], GRAMS, r["shard"], 0, _squeeze(logp[np.searchsorted(gram, _gram_keys(r))])) for r in asked.to_pylist()])


def _word_answers(asked: pa.Table) -> pa.Table:
    """Each word's training count over all blocks; a shard's first answer has its number of words that have one."""
    total: dict[bytes, int] = {}
    rows = asked.to_pylist()
    split = [zstandard.ZstdDecompressor().decompress(r["keys"]).split(b" ") for r in rows]
    for words, r in zip(split, rows):
        for w, n in zip(words, _expand(r["counts"], np.uint32).tolist()):
            total[w] = total.get(w, 0) + n
    known = sum(n > 0 for n in total.values())
    return _answers([(r["block"], WORDS, r["shard"], known if k == 0 else 0, _squeeze(np.array([total[w] for w in words], np.int64)))
                     for k, (words, r) in enumerate(zip(split, rows))])


def trie(grams: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """From (gram, c) of the longest contexts: per order j, seen (gram, c), and nodes (ctx, t, d, e), e being
    what the bytes seen after ctx count after the next shorter context."""
    seen, nodes = [], []
    for j in range(order + 1):
        mask = (1 << 8 * (j + 1)) - 1
        seen.append(grams.where("c > 0").groupBy(F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.sum("c").alias("c")))
    for j in range(order + 1):
        rows = seen[j]
        if j:
            lower = (1 << 8 * j) - 1
            shorter = seen[j - 1].select(F.col("gram").alias("low"), F.col("c").alias("lc"))
            rows = rows.withColumn("low", F.col("gram").bitwiseAND(F.lit(lower))).join(shorter, "low")
        else:
            rows = rows.withColumn("lc", F.lit(0).cast("long"))
        nodes.append(rows.groupBy(F.shiftright("gram", 8).alias("ctx"))
                     .agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("d"), F.sum("lc").alias("e")))
    return seen, nodes


def log_probabilities(grams: DataFrame, order: int) -> DataFrame:
    """(shard, gram, c) of every context-with-byte asked for, c its training count -> (shard, gram, logp)."""
    seen, nodes = trie(grams, order)
    state = grams.select("shard", "gram", F.lit(0.0).alias("logp"), F.lit(False).alias("done"),
                         F.lit(0).cast("long").alias("xt"), F.lit(0).cast("long").alias("xd"))
    root = nodes[0].first()
    for j in range(order, -1, -1):
        mask = (1 << 8 * (j + 1)) - 1
        own, node = seen[j].withColumnRenamed("gram", "own"), nodes[j]
        if j <= 1:        # at most 65,536 rows and 256 rows, whatever the corpus
            own, node = F.broadcast(own), F.broadcast(node)
        state = state.withColumn("own", F.col("gram").bitwiseAND(F.lit(mask)))
        state = state.join(own, "own", "left").withColumn("ctx", F.shiftright("own", 8))
        if j:
            state = state.join(node, "ctx", "left")
        else:
            state = state.withColumn("t", F.lit(root["t"] if root else None).cast("long")) \
                         .withColumn("d", F.lit(root["d"] if root else None).cast("long")).withColumn("e", F.lit(0).cast("long"))
        t, d = F.col("t") - F.col("xt"), F.col("d") - F.col("xd")
        step = (F.when(F.col("done") | F.col("t").isNull() | (t <= 0), 0.0)
                 .when(F.col("c").isNotNull(), F.log10((2 * F.col("c") - 1) / (2 * t))).otherwise(F.log10(d / (2 * t))))
        met = ~F.col("done") & F.col("t").isNotNull()
        state = state.select("shard", "gram", (F.col("logp") + step).alias("logp"), (F.col("done") | F.col("c").isNotNull()).alias("done"),
                             F.when(met, F.col("e")).otherwise(F.col("xt")).alias("xt"),
                             F.when(met, F.col("d")).otherwise(F.col("xd")).alias("xd"))
    rest = float(np.log10(1 / max(1, SYMBOLS - (root["d"] if root else 0))))
    return state.select("shard", "gram", (F.col("logp") + F.when(F.col("done"), 0.0).otherwise(F.lit(rest))).alias("logp"))


class _Lookup:
    """Values of sorted keys: a table by hash, and a binary search for the keys that share a place in it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values, bits = keys, values, max(10, int(len(keys)).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        self.at = np.full(1 << bits, -1, np.int64)
        self.with_ = np.zeros(1 << bits, values.dtype)
        place = self._place(keys)
        self.at[place], self.with_[place] = keys, values

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        place = self._place(keys)
        out = self.with_[place].astype(np.float64)
        other = np.flatnonzero(self.at[place] != keys)
        out[other] = self.values[np.searchsorted(self.keys, keys[other])]
        return out


def _scores(order: int, shards: int):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("logs", pa.float64()), ("score", pa.float64()), ("block_words", pa.int64())])

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return schema.empty_table()
        docs = pa.ipc.open_stream(texts.column("keys")[0].as_py()).read_all()
        body = docs.column("text").to_pylist()
        grams, words = _grams(body, order), _words(body)
        gram_shard, word_shard = _gram_shards(grams, shards), _word_shards(words, shards)
        logp, count, new = np.zeros(len(grams)), np.zeros(len(words)), 0
        for r in answers.to_pylist():
            if r["kind"] == GRAMS:
                logp[gram_shard == r["shard"]] = _expand(r["values"], np.float32)
            else:
                count[word_shard == r["shard"]] = _expand(r["values"], np.int64)
                new += r["known"]
        look, score = _Lookup(grams, logp), []
        for code, begins, *_ in _codes(body, order):
            score.append(np.add.reduceat(look(code), begins))
        place, log, known = {w: i for i, w in enumerate(words)}, np.log10(count + 0.1), count > 0
        rows = []
        for text in body:
            at = np.fromiter(map(place.__getitem__, text.split()), np.int64)
            rows.append((len(at) + 1, int(known[at].sum()), float(log[at].sum())))
        tokens, seen, logs = zip(*rows)
        return pa.Table.from_arrays([docs.column("doc_id").combine_chunks(), docs.column("held_out").combine_chunks(),
                                     pa.array(tokens, pa.int64()), pa.array(seen, pa.int64()), pa.array(logs, pa.float64()),
                                     pa.array(np.concatenate(score)), pa.array([new] + [0] * (len(body) - 1), pa.int64())], schema=schema)
    return run


def score(docs: DataFrame, order: int = 5, fold: int = 10, block_bytes: int = 8_000_000, shard_bytes: int = 16_000_000) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); trained on the
    documents whose crc32(doc_id as text) mod ``fold`` is not 0, the others being held out."""
    texts = docs.select(column_or_null(docs, "doc_id", "long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(min(1 << 30, size // shard_bytes + 8))
    asked = materialize_by(texts.mapInArrow(lambda b: _asked(b, order, block_bytes, shards, fold), _KIND), "ppm-asked", "kind")
    grams = asked.where(F.col("kind") == GRAMS).select(F.col("shard").alias("to"), "block", "shard", "keys", "counts")
    sums = materialize(grams.groupBy("to").applyInArrow(lambda t: _gram_sums(t), "shard int, gram long, c long"), "ppm-grams")
    logp = materialize(log_probabilities(sums, order), "ppm-trie")
    shape = "block long, kind int, shard int, known long, values binary"
    told = (grams.drop("counts").groupBy("to").cogroup(logp.groupBy("shard")).applyInArrow(_gram_answers, shape)
            .unionByName(asked.where(F.col("kind") == WORDS).select(F.col("shard").alias("to"), "block", "shard", "keys", "counts")
                         .groupBy("to").applyInArrow(lambda t: _word_answers(t), shape)))
    blocks = asked.where(F.col("kind") == TEXTS).select(F.col("block").alias("at"), "keys")
    found = materialize(blocks.groupBy("at").cogroup(told.groupBy("block")).applyInArrow(
        _scores(order, shards), "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, block_words long"),
        "ppm-scores")
    trained, n, different = found.agg(F.count_if(~F.col("held_out")), F.sum(F.when(~F.col("held_out"), F.col("n_tokens"))),
                                      F.sum("block_words")).first()
    trained, n, different = trained or 0, n or 0, (different or 0) + bool(trained)      # with the end
    end = float(np.log10(trained + 0.1))
    return found.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.lit(int(trained > 0))).cast("long").alias("n_known"),
                        F.lit(n).cast("long").alias("train_tokens"),
                        (F.col("logs") + F.lit(end) - F.col("n_tokens") * F.lit(float(np.log10(n + 0.1 * (different + 1)))))
                        .alias("base_score"), "score")
