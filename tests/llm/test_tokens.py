"""Token ids, binary shards and packing: exact round trips."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluicegate.llm import binary_output as bo
from sluicegate.llm import packing
from sluicegate.llm.tokenize import encoder


def whole(name, text):
    return [*encoder(name).tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_the_whole_text(name):
    rnd = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "b'", "'s", "é", "é", "́", "\xa0", "\x1c", "\x85", " ", "　", "​", "1", "½", ".", "%", "<|endoftext|>", "Σ", "ΑΣ", "中文", "'", "re"]
    texts = ["", None, "\n\n\n", "x" * 100, "  lead", "trail  ", "a   b \n\n c"]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(2000)]
    for text in texts:
        assert np.frombuffer(encoder(name).encode(text), "<u4").tolist() == whole(name, text), repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_slices_and_special_tokens(name):
    """Texts encoded together give what each gives alone; strings of special tokens are those tokens, or text where asked for."""
    rnd = random.Random(3)
    bits = [" ", " ", "\n", "a", "bc", ".", "?!", "#", "bc%", "½", "١", "\t", "x" * 60, "<|endoftext|>", "<|startoftext|>", "<|end", "\x85", "1", "é", "\n\n"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(3000)] + [None]
    coder = encoder(name)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in coder.encode_all(texts)]
    coder.tokenizer.encode_special_tokens = False
    assert got == [whole(name, t) for t in texts]
    assert all(len(p) <= 48 for p in [*coder.plain, *coder.after_blank])
    as_text = encoder(name, None, True)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in as_text.encode_all(texts)]
    as_text.tokenizer.encode_special_tokens = True
    assert got == [[*as_text.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


class Counting:
    """A tokenizer that counts the characters it is given in batches."""

    def __init__(self, inner):
        self.__dict__.update(inner=inner, characters=0)

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def __setattr__(self, name, value):
        setattr(self.inner, name, value)

    def encode_batch_fast(self, texts, **options):
        self.__dict__["characters"] += sum(map(len, texts))
        return self.inner.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_pass_the_model_alone(name):
    """Thousands of words never met take no pass through the whole tokenizer, in whatever case and before whatever marks."""
    from sluicegate.llm.tokenize import Encoder

    rnd = random.Random(5)
    coder = Encoder(name)
    words = ["".join(rnd.choice("aeiounrstléüñçßÉT") for _ in range(rnd.randint(1, 12))) for _ in range(5000)]
    texts = [" ".join(words[a : a + 50]) for a in range(0, 5000, 50)]
    coder.tokenizer = Counting(coder.tokenizer)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in coder.encode_all(texts)]
    assert coder.tokenizer.characters == 0
    assert got == [whole(name, t) for t in texts]
    texts = [" ".join(word + rnd.choice([".", ",", "!", "", "?!", ".\n"]) for word in words[a : a + 50]) for a in range(0, 5000, 50)]
    got = [np.frombuffer(raw, "<u4").tolist() for raw in coder.encode_all(texts)]
    assert coder.tokenizer.characters < 300  # marks, the ends of lines, and what puts them apart
    assert got == [whole(name, t) for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cuts_are_those_of_the_whole_text(name):
    """A dotted capital I takes its dot along in lower case, which then joins the marks; every letter near it, wide spaces, combining characters."""
    rnd = random.Random(6)
    bits = [" "] * 6 + ["\n", "\r\n", "\v", "\f ", "    ", "B", "The", "'S", "'ll", ".", ",", "?!", "İ", "H", "h", "\u0331", "\u0338", "×", "÷", "º", "Ⱥ", "\u1680", "\u2009", "\u2028", "\u3000"]
    bits += ["\u201d", "…", "\u0130x", "<|ENDOFTEXT|>", "<|", "Σ", "ж", "😀", "\0", "\u00ad", "y" * 50]
    texts = ["İ.", "x İ, y", "a\n b", " \nb", "a \n\nb\n", "H\u0331 h\u0331."] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    texts += [x for c in map(chr, range(0x300)) for x in (c, c + ".", f"a{c} b", f" {c}a?{c}")]
    coder = encoder(name)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in coder.encode_all(texts)]
    coder.tokenizer.encode_special_tokens = False
    for text, ids in zip(texts, got):
        assert ids == whole(name, text), repr(text)


def test_columns_in_slices_and_long_pieces():
    from sluicegate.llm.tokenize import Encoder, binary

    coder = Encoder("word_bpe_49k.json")
    column = pa.array(["left out", None, "one two", "", "<|endoftext|> z", None, "three"])[1:]
    ids, ends = coder.encode_column(column)
    cuts = [0, *ends.tolist()]
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])] == [whole("word_bpe_49k.json", t) for t in column.to_pylist()]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in binary(ids, ends).to_pylist()] == [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
    assert [len(part) for part in coder.encode_column(column[:0])] == [0, 0]
    before = coder.used, coder.count
    coder.encode("z" * 500 + " " + "1" * 500)
    assert (coder.used, coder.count) == before


def test_memory_is_bounded(monkeypatch):
    from sluicegate.llm import tokenize

    monkeypatch.setattr(tokenize, "REMEMBERED", 50)
    coder = tokenize.Encoder("byte_bpe_50k.json")
    for k in range(20):
        text = " ".join(f"w{k}x{i}" for i in range(30))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == whole("byte_bpe_50k.json", text)
        assert len(coder.plain) + len(coder.after_blank) <= 80


def test_large_vocabularies_are_refused():
    from sluicegate.llm.tokenize import narrow

    assert narrow(b"\x01\0\0\0", 1 << 16).tolist() == [1]
    with pytest.raises(ValueError, match="16 bits"):
        narrow(b"", 100_000)


def test_variable_length_coding_round_trip():
    rnd = np.random.default_rng(2)
    docs = [rnd.integers(0, 2 ** rnd.integers(1, 33), rnd.integers(0, 30)).astype(np.uint32) for _ in range(200)]
    docs += [np.array([0, 255, 256, 65_535, 65_536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)]
    coded = [bo.encode_values(d) for d in docs]
    raw = bo.pack_shard(list(range(len(docs))), [len(d) for d in docs], [c for c, _ in coded], [d for _, d in coded])
    ids, counts, values = bo.unpack_shard(raw)
    assert ids == list(range(len(docs))) and counts.tolist() == [len(d) for d in docs]
    assert np.array_equal(values, np.concatenate(docs))
    with pytest.raises(ValueError):
        bo.unpack_shard(b"nothing of the kind")


def test_files_hold_all_ids_in_order(spark, odd, texts, tmp_path):
    folder = str(tmp_path / "shards")
    shards = bo.write_shards(odd, folder, shard_tokens=500)
    rows = sorted(bo.read_shards(spark, folder, shards).collect(), key=lambda r: r.start)
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in rows] == [i for i, _ in order]
    start = 0
    for (_, text), r in zip(order, rows):
        ids = whole("byte_bpe_50k.json", text)
        assert (r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    ranks = np.frombuffer((tmp_path / "shards" / "ranks.bin").read_bytes(), "<u4")
    count = Counter(t for _, text in texts for t in whole("byte_bpe_50k.json", text))
    assert ranks[:20].tolist() == sorted(count, key=lambda t: (-count[t], t))[:20]


def test_files_of_nothing(nothing, tmp_path):
    assert bo.write_shards(nothing, str(tmp_path / "none")).count() == 0


def check_windows(rows, length):
    windows = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, pieces in windows.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
        assert at == length or k == max(windows)
        assert at <= length
    assert sorted(windows) == list(range(len(windows)))


def test_pieces_cover_every_id_once(odd, texts):
    rows = packing.pack(odd, length=64).collect()
    check_windows(rows, 64)
    want = Counter()
    for i, text in texts:
        want.update([(i, tuple(whole("word_bpe_49k.json", text)))])
    got, parts = Counter(), {}
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.start)):
        parts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for (i, size), own in parts.items():
        ids = np.zeros((size,), np.int64)
        seen = Counter()
        for r in own:
            piece = np.frombuffer(r.ids, "<u4")
            assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
            ids[r.start : r.start + r.length] = piece
            seen.update(range(r.start, r.start + r.length))
        copies = set(seen.values())
        assert len(copies) == 1 and len(seen) == size
        got[i, tuple(ids.tolist())] += copies.pop()
    assert got == want


def test_mixture_and_deficits():
    """Every window gives each queue its share but for less than two tokens, at any number of windows."""
    rnd = random.Random(3)
    for _ in range(60):
        length, n = rnd.choice([16, 64, 4096]), rnd.randint(1, 6)
        totals = {f"s{i}": rnd.randint(1, 40_000) for i in range(n)}
        weights = {s: rnd.randint(1, 4) for s in totals} if rnd.random() < 0.5 else None
        queue = packing.queues_of(totals, weights, length)
        sizes, shares = [0] * (max(queue.values()) + 1), [0] * (max(queue.values()) + 1)
        for s, k in queue.items():
            sizes[k] += totals[s]
            shares[k] += weights[s] if weights else 0
        plan = packing.phases(sizes, shares if weights else None, length)
        windows = sum(p.windows for p in plan)
        assert windows == -(-sum(sizes) // length)
        for k, size in enumerate(sizes):
            pieces, at = [], 0
            while at < size:
                step = min(size - at, rnd.randint(1, 3000))
                pieces += [(w, n) for _, n, w, _ in packing.cut(plan, k, at, step, length)]
                at += step
            assert sum(n for _, n in pieces) == size
            first = plan[0]
            for w in range(first.windows if first.windows > 1 else 0):
                taken = sum(n for v, n in pieces if v == w)
                share = first.taken(k, first.windows) / first.windows
                assert abs(taken - share) < 2


def test_packing_of_nothing_and_bad_weights(nothing, odd):
    assert packing.pack(nothing).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd, weights={"src0": 1.0})


def test_packed_ids_of_a_dotted_capital(spark):
    """The dot that lower case makes of it belongs to the marks after it; beside nulls and strings of special tokens."""
    texts = ["İ. x İ, y", None, "<|endoftext|> İ!", "", "plain words."]
    rows = packing.pack(spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in rows} == {i: whole("word_bpe_49k.json", t) for i, t in enumerate(texts)}
