"""Packing against the tokenizer's ids of whole texts."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tierwell.llm import packing, queries
from tierwell.llm.packing import Item, Limits, Packer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))


def expected_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def padding(lengths, limit=2048):
    return sum(0 if n & (n - 1) == 0 else limit - n for n in lengths)


def test_pieces_hold_each_id_once(spark, folder, rows, tokenizer):
    made = queries.op13_packing(spark, folder).collect()
    ids = defaultdict(list)
    for r in rows:
        ids[r[0]].append(expected_ids(tokenizer, r[1]))
    sequences, covered = defaultdict(list), defaultdict(list)
    for p in made:
        sequences[p.sequence_id].append((p.offset, p.length))
        covered[p.doc_id].append((p.doc_tokens, p.start, p.length, p.ids_crc32))
    lengths = []
    for pieces in sequences.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces]])[:-1].tolist()
        lengths.append(sum(n for _, n in pieces))
        assert len(pieces) <= 64
    assert max(lengths) <= 2048 and padding(lengths) == 0
    for doc_id, texts in ids.items():
        # Each piece is one of a text with this id; together they are as long as the texts.
        assert sum(p[2] for p in covered[doc_id]) == sum(map(len, texts))
        if len(texts) == 1:
            pieces = sorted(covered[doc_id], key=lambda p: p[1])
            own = np.array(texts[0], "<u4")
            assert [p[1] for p in pieces] == np.cumsum([0, *[p[2] for p in pieces]])[:-1].tolist()
            assert all(p[0] == len(own) for p in pieces)
            assert all(zlib.crc32(own[p[1] : p[1] + p[2]].tobytes()) == p[3] for p in pieces)
        sums = {zlib.crc32(np.array(t, "<u4")[p[1] : p[1] + p[2]].tobytes()) for t in texts for p in covered[doc_id]}
        assert all(p[3] in sums for p in covered[doc_id])


def test_words_are_those_of_whole_texts(tokenizer):
    texts = ["A<|endoftext|>b <|endoftext|>", "Éa é ́x y z\x1cq\x85w", "İ ß Σας ΑΣ 12 ½ don't", " \n", None, "\x00 a\x0bb"]
    made = packing.Words(tokenizer)(pa.array(texts))
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [expected_ids(tokenizer, t)[:-1] for t in texts]


@pytest.mark.parametrize("limits", [Limits(64, 5, 40), Limits(64, 3, 64), Limits(64, 64, 7)])
def test_limits_hold_together(limits):
    rng = np.random.default_rng(3)
    packer, made, total = Packer(limits, 32), [], 0
    for owner in range(500):
        n = int(rng.choice([1, 2, 9, 30, 200]))
        total += n
        quiet = int(rng.integers(0, n + 1))
        made += packer.add(Item(owner, np.arange(n, dtype="<u4").tobytes(), n, quiet))
    made += packer.bins()
    seen = defaultdict(list)
    for sequence in made:
        length = sum(i.tokens for i in sequence)
        assert length <= 64 and (length & (length - 1)) == 0
        assert len(sequence) <= limits.segments and sum(i.loss for i in sequence) <= limits.loss
        for i in sequence:
            seen[i.owner].append((i.start, np.frombuffer(i.ids, "<u4").tolist()))
    assert sum(len(ids) for pieces in seen.values() for _, ids in pieces) == total
    for pieces in seen.values():
        ids = [k for _, piece in sorted(pieces) for k in piece]
        assert ids == list(range(len(ids)))


def test_the_dot_product_prefers_what_fills_the_scarce_room():
    """With little room left for loss, quiet items go in before a loud one of the same length."""
    packer = Packer(Limits(64, 8, 20), 8)
    for owner, n, quiet in (("loud", 16, 0), ("quiet", 16, 16), ("first", 32, 16), ("silent", 16, 16)):
        assert not list(packer.add(Item(owner, bytes(4 * n), n, quiet)))
    assert [i.owner for i in packer.bin()] == ["first", "quiet", "silent"]


def test_prompts_bear_no_loss(spark, tokenizer):
    rows = [(1, "two words", "a question"), (2, None, None), (None, "x", ""), (1, "", "only asked")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ask string")
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    made = packing.packed(df, lambda: packing.words_of(path), prompt="ask", with_ids=True).collect()
    total = sum(len(expected_ids(tokenizer, t)) for _, t, _ in rows)
    asked = sum(len(expected_ids(tokenizer, a)) - 1 for _, _, a in rows)
    assert sum(p.loss for p in made) == total
    assert sum(len(p.ids) for p in made) == total + asked


def test_empty_table(empty):
    path = str(public_tokenizers.path("word_bpe_49k.json"))
    assert packing.packed(empty, lambda: packing.words_of(path)).collect() == []
