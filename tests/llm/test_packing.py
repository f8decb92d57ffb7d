import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import word_bpe

TEXTS = ["It's a test, isn't it? 12.5 (x)", "HELLO  world\x0b\x0cagain\r\n", "Éé Ñandú Straße İI ΣΑΣ ét́", "",
         None, "<|endoftext|> <|startoftext|>x", "a b c\u0085d\x1cf", "日本語 テキスト ok", "'s 're '' ... !!? a.b.c", "don't.stop",
         "word " * 9000, "Zz" * 3000, "Anblewh sttible| *** of%%%", "emoji 👍🏽 ok ́x ﻿"]


def test_chunks_encode_as_whole_text():
    whole, encode = Tokenizer.from_file(word_bpe()), packing.chunk_encoder(word_bpe())
    rnd = random.Random(1)
    alphabet = "aAbBéÉß'sΣİ 12.,!|<>\n\t ́"
    for text in [t for t in TEXTS if t] + ["".join(rnd.choices(alphabet, k=30)) for _ in range(500)]:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text[:60])


def optimum(lengths, cap):
    best = [len(lengths)]

    def go(rest, rooms):
        if len(rooms) >= best[0]:
            return
        if not rest:
            best[0] = len(rooms)
            return
        x, *rest = rest
        for i in {r: i for i, r in enumerate(rooms) if r >= x}.values():
            go(rest, rooms[:i] + [rooms[i] - x] + rooms[i + 1:])
        go(rest, rooms + [cap - x])
    go(sorted(lengths, reverse=True), [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rnd = random.Random(5)
    fixed_some = 0
    for _ in range(150):
        cap = rnd.choice([10, 17, 30])
        lengths = [rnd.randint(1, cap) for _ in range(rnd.randint(1, 8))]
        count = np.bincount(lengths, minlength=cap + 1)
        fixed = packing.reduce_dominated(count, cap)
        rest = np.repeat(np.arange(cap + 1), count).tolist()
        fixed_some += bool(fixed)
        assert sum(n for _, n in fixed) + (optimum(rest, cap) if rest else 0) == optimum(lengths, cap)
        assert sorted([x for c, n in fixed for x in c * n] + rest) == sorted(lengths)
        assert all(sum(c) <= cap for c, _ in fixed)
    assert fixed_some > 100


def test_packs_every_piece(spark):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "x", 1), (3, "y", 1), (3, "y", 1)]
    rows += [(100 + i, "of " * (i % 50 + 1), 1) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    out = packing.pack(df, word_bpe()).sequences().collect()
    whole = Tokenizer.from_file(word_bpe())
    want = defaultdict(int)
    for i, t, _ in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        for at in range(0, len(ids), 4096):
            want[i, at // 4096, at, zlib.crc32(np.array(ids[at:at + 4096], "<u4").tobytes())] += 1
    got, bins = defaultdict(int), defaultdict(list)
    for r in out:
        assert len(r["ids"]) == 4 * r["length"]
        got[r["doc_id"], r["piece"], r["start"], zlib.crc32(bytes(r["ids"]))] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r["length"] for r in out)
    assert len(bins) <= -(-total // 4096) + 1
    assert packing.pack(df.limit(0), word_bpe()).sequences().count() == 0


def test_ranks_over_salts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED", 7)
    df = spark.createDataFrame([(i, "a b c") for i in range(100)], "doc_id long, text string")
    out = packing.pack(df, word_bpe(), capacity=10).sequences().collect()
    assert len({(r["sequence_id"], r["offset"]) for r in out}) == 100 and max(r["offset"] for r in out) == 4
