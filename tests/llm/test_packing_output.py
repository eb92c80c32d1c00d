import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rewardloom.llm import tokens
from rewardloom.llm.packing import fullest, pack
from rewardloom.llm.pfor import decode, encode, encode_and_read
from rewardloom.llm.tokens import Encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def whole(path, texts):
    t = Tokenizer.from_file(path)
    return [np.array(e.ids + [2], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path,spaces", [(BYTE, "kept"), (WORD, "dropped")])
def test_chunks_give_the_library_s_ids(path, spaces):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "\0", " ", "a", "b", "é", "É", "1", "23", "'s", "'", "!", "\r\n", "́", "İ", "ς", "中",
             "<|endoftext|>", "\x1c", " ", ".", "  \n ", "​", "\x85", "ß", "wor", "$$$", "×", "Word,", "x" * 60]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    got = Encoder(path, spaces).batch(texts)
    assert all(g == w[:-1].tobytes() for g, w in zip(got, whole(path, texts)))


@pytest.mark.parametrize("path,spaces", [(BYTE, "kept"), (WORD, "dropped")])
def test_special_strings_get_their_ids(path, spaces):
    plain = Tokenizer.from_file(path)
    mark = plain.token_to_id("<|endoftext|>")
    texts = ["before <|endoftext|> behind", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "a  b<|endoftext|>  c\n\n<|startoftext|> d",
             "<|endoftext|<|endoftext|>>", "<|ENDOFTEXT|> < |endoftext| >", "\0<|endoftext|>\0", ""]
    enc = Encoder(path, spaces)
    for _ in range(2):           # learned, then looked up
        got = enc.batch(texts)
        assert got == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [mark in np.frombuffer(x, "<u4") for x in got] == [True] * 5 + [False, True, False]


def test_fullest_is_the_best_subset():
    rng = random.Random(1)
    for _ in range(200):
        lengths = [rng.randint(1, 30) for _ in range(rng.randint(0, 9))]
        count = defaultdict(int)
        for x in lengths:
            count[x] += 1
        best = max((s for s in (sum(x for i, x in enumerate(lengths) if m >> i & 1) for m in range(1 << len(lengths))) if s <= 40), default=0)
        taken = fullest(dict(count), 40)
        assert sum(k * n for k, n in taken.items()) == best and all(0 < n <= count[k] for k, n in taken.items())


def check_pieces(df, rows, capacity):
    ids = defaultdict(list)
    for (i, _), x in zip(rows, whole(WORD, [t for _, t in rows])):
        ids[i].append(x)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in df.collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for i, rs in pieces.items():
        assert sum(r.length for r in rs) == sum(len(x) for x in ids[i])
        if len(ids[i]) == 1:
            x, at = ids[i][0], 0
            for r in sorted(rs, key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(x[at:at + r.length].tobytes())
                at += r.length
    padding = 0
    for rs in sequences.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding


def test_packing(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    total = sum(len(x) for x in whole(WORD, [t for _, t in rows]))
    assert check_pieces(pack(docs.repartition(2), WORD, "dropped"), rows, 4096) <= 0.01 * total
    assert check_pieces(pack(docs, WORD, "dropped", capacity=64, pool=8), rows, 64) <= 0.05 * total


def test_packing_edges(edge, empty):
    check_pieces(pack(edge, WORD, "dropped"), [tuple(r) for r in edge.select("doc_id", "text").collect()], 4096)
    assert pack(empty, WORD, "dropped").count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 127, 128, 129, 5000):
        for top in (1, 2, 300, 50_000, 2**32):
            x = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
            x[rng.random(n) < 0.03] = 2**32 - 1
            assert (decode(encode(x)) == x).all()
    small = rng.integers(1000, 1008, 4096).astype(np.uint32)
    assert len(encode(small)) < 4096 * 4 / 8
    with pytest.raises(ValueError):
        decode(b"none")


@pytest.mark.parametrize("which", ["docs", "edge", "empty"])
def test_written_and_read(which, request):
    df = request.getfixturevalue(which)
    rows = sorted([tuple(r) for r in df.select("doc_id", "text").collect()], key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted([tuple(r) for r in encode_and_read(df, BYTE, "kept").collect()], key=lambda r: r[1])
    assert [g[0] for g in got] == [r[0] for r in rows]
    at = 0
    for g, x in zip(got, whole(BYTE, [t for _, t in rows])):
        assert g[1:] == (at, len(x), zlib.crc32(x.tobytes()))
        at += len(x)


@pytest.mark.parametrize("path,spaces", [(BYTE, "kept"), (WORD, "dropped")])
def test_chunks_in_use_are_spelled_once(path, spaces, monkeypatch):
    """Chunks that come again aren't learned again when the dictionary is full."""
    monkeypatch.setattr(tokens, "MOST", 60)
    enc, spelled = Encoder(path, spaces), Counter()

    class Model:
        def __init__(self, model):
            self.model = model

        def tokenize(self, text):
            spelled[text] += 1
            return self.model.tokenize(text)

    enc.model = Model(enc.model)
    rng = random.Random(5)
    usual = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(40)]
    for _ in range(12):
        rare = ["".join(rng.choices("mnopqrst", k=8)) for _ in range(15)]
        texts = [" ".join(rng.sample(usual, 40) + rare), " ".join(rare[:5] + usual)]
        assert enc.batch(texts) == [x[:-1].tobytes() for x in whole(path, texts)]
    assert len(spelled) > 200 and max(spelled.values()) <= 2        # a word may begin a text: spelled without its space
    assert len(enc.seen) + len(enc.older) < 4 * tokens.MOST
