import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voxloom.llm import token_grammar as G

from .conftest import text

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a  b", " a", "a ", "a\n b \n", "tab\t x", "  q　 z", "été 12 34a!! **", "it's 'll a", "x <|endoftext|> y", "a<|endoftext|>b c", "\x1c \x1c a", "end. of, it", "b one.\nTwo, x three\nfour's y don't.\nIt b12\nc5,; d.\n\nE f\n\n", "x a\u0301b. Ünï***\nÉé!! \u2028z q\u2028w r", "x.y ,z", "日本 語、 b", "  a", "a" * 5000 + " b", "end.) x?! a,b c:\nd e.;\n f!' g.s h.\u0301 i?é"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def encoded(encode, texts):
    import pyarrow as pa

    ids, lengths = encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]


def test_encoder_gives_the_library_s_ids(tokenizer):
    texts = ODD + [text(i, 300) + "\n" + text(i, 20).title() + ", and. so" for i in range(20)]
    assert encoded(G.Encoder(PATH), texts) == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_encoder_of_another_kind_of_vocabulary():
    """Words with ends, lower case, white space dropped: pieces say nothing there, so whole texts go to the library."""
    path = public_tokenizers.path("word_bpe_49k.json")
    assert G.Encoder(PATH).by_pieces and not G.Encoder(path).by_pieces
    texts = ODD + [text(i, 100).title() + "\n x." for i in range(5)]
    library = Tokenizer.from_file(path)
    assert encoded(G.Encoder(path), texts) == [library.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_encoder_with_a_full_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(G, "MOST_PIECES", 10)
    encode = G.Encoder(PATH)
    for i in range(3):
        texts = [text(i, 200) + ", x." for _ in range(3)]
        assert encoded(encode, texts) == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_encoder_meets_words_once_whatever_stands_around_them(tokenizer):
    """The work of a text follows its different words and signs, not how they are put together."""
    words, signs = sorted(set(text(1, 500).split())), [".", ",", ";", ":", "!", "?", ".\n", "!!\n", ")", ""]
    texts = [" ".join(w + s for w in words) for s in signs] + ["\n".join(words)]
    encode = G.Encoder(PATH)
    assert encoded(encode, texts) == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    held = sum(len(x) for x in vars(encode).values() if isinstance(x, dict))
    assert held < 4 * len(words) + 50


def test_encoder_at_odd_places(tokenizer):
    """Random texts of characters that are split in their own ways."""
    rng = np.random.default_rng(11)
    plain = [" ", " ", "\n", "a", "b.", "the", "é", "12", ", "]
    odd = [" ", "\n", "\t", "\x1c", "\x85", "\u3000", "'", "'ll", "ª", "\u0301", "²", "--", "—", "🙂", "<|endoftext|>", "<|", "\x00", "İ", "x"]
    texts = ["".join(rng.choice(odd if rng.random() < 0.3 else plain) for _ in range(rng.integers(0, 20))) for _ in range(4000)]
    assert encoded(G.Encoder(PATH), texts) == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_shards_round_trip(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [3, 50, 300, 50_000, 70_000, 2][seed]
    lengths = rng.integers(0, 400, 300)
    ids = (rng.integers(0, vocabulary, lengths.sum()) ** 2 // vocabulary).astype(np.uint32)
    doc_ids = [None if i % 50 == 7 else int(i) - 100 for i in range(300)]
    data = G.write_shard(doc_ids, lengths, ids, max(vocabulary, 10))
    shard = G.Shard(data)
    assert shard.doc_ids == doc_ids and shard.lengths.tolist() == lengths.tolist()
    assert (shard.ids() == ids).all()
    assert (shard.size[shard.base :] == [len(shard._spread(shard.row, np.array([s]))) for s in range(shard.base, len(shard.size))]).all()
    for _ in range(40):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert (shard.ids(a, b) == ids[a:b]).all()
    ends = np.cumsum(lengths)
    for i in (0, 17, 299):
        assert (shard.document(i) == ids[ends[i] - lengths[i] : ends[i]]).all()


def test_rules_stay_within_documents_and_compress():
    ids = np.tile([5, 6, 7, 8], 3000).astype(np.uint32)
    lengths = np.full(3000, 4)
    shard = G.Shard(G.write_shard(list(range(3000)), lengths, ids, 10))
    assert shard.n_symbols == 3000 and (shard.size[shard.symbols(0, 3000)] == 4).all()
    plain = G.Shard(G.write_shard([1], np.array([3]), np.array([1, 2, 3]), 10))
    assert len(plain.left) == 0 and plain.ids().tolist() == [1, 2, 3]
    assert G.Shard(G.write_shard([], np.zeros(0, np.int64), np.zeros(0, np.uint32), 10)).ids().tolist() == []
    with pytest.raises(ValueError, match="version"):
        G.Shard(b"nope" + bytes(60))


def frequent(seq):
    """Pairs that occur twice without overlap."""
    places = {}
    for i, pair in enumerate(zip(seq, seq[1:], strict=False)):
        if not places.get(pair) or places[pair][-1] < i - 1:
            places.setdefault(pair, []).append(i)
    return [p for p, at in places.items() if len(at) > 1]


@pytest.mark.parametrize("kind", ["copies", "runs", "few"])
def test_rounds_end_when_no_pair_is_frequent(kind):
    rng = np.random.default_rng(3)
    alone = rng.permutation(np.arange(10, 40_010))
    passage = rng.integers(10, 40_010, 1000)
    ids = {
        "copies": np.concatenate([x for k in range(20) for x in (alone[2000 * k : 2000 * k + 2000], passage)]),
        "runs": np.repeat(rng.integers(0, 40, 3000), rng.integers(1, 9, 3000)),
        "few": rng.integers(0, 3, 5000),
    }[kind].astype(np.uint32)
    shard = G.Shard(G.write_shard([1], np.array([len(ids)]), ids, 50_000))
    assert (shard.ids() == ids).all()
    assert not frequent(shard.symbols(0, shard.n_symbols).tolist())
    if kind == "copies":
        assert shard.n_symbols < 40_000 + 20 * 20


@pytest.mark.parametrize("base", [20_000, 1 << 30])
def test_one_round_counts_all_pairs(base):
    pairs = np.arange(20_000, dtype=np.uint32) + base - 20_000
    ids = np.tile(pairs, 2)
    seq, rounds = G.pair_rules(ids, np.arange(len(ids)) % 2 == 1, base)
    assert [len(r) for r in rounds] == [10_000] and len(seq) == 20_000


def test_equals_the_library(documents, tokenizer):
    rows = [(i * 7 % 101, text(i, 5 + i * 3)) for i in range(101)] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None), (None, "null id")]
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in G.token_ids(documents(rows, clashing=True), PATH, shard_tokens=700).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_repeated_rows_and_empty_tables(documents, tokenizer):
    rows = [(5, "same"), (5, "same"), (5, "other words"), (None, "same"), (None, "same")]
    got = sorted(tuple(r)[1:3] for r in G.token_ids(documents(rows), PATH).collect())
    assert [a for a, _ in got] == [sum(n for _, n in got[:i]) for i in range(5)]
    assert G.token_ids(documents(rows).limit(0), PATH).count() == 0
