import random
import struct
import zlib
from array import array

import pytest

from tidemark.llm import packing, pieces, seekable
from tidemark.llm.words import located as tokenizer_path
from tidemark.llm.words import WordEncoder, pack
from tidemark.session import scratch_path

BYTES, WORDS, SP = (tokenizer_path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def library(path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return lambda t: pack(tok.encode(t or "", add_special_tokens=False).ids)


def samples(n=1500):
    rng = random.Random(4)
    alphabet = list("ab cAB  \n\t'sé!.,$12▁") + ["\xa0", "\x1c", "\x85", "中", "́", "'ll", "<|endoftext|>", "İ", "Σ", "\r\n", "ing", "the"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_word_memory_equals_library(path, odd_rows):
    enc, ref = WordEncoder(path), library(path)
    for text in samples() + [t or "" for _, t in odd_rows]:
        assert enc.encode(text) == ref(text), repr(text[:80])


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("most", [1, 500, 1 << 24])
def test_batches_equal_single_texts(path, most, odd_rows, monkeypatch):
    import pyarrow as pa

    from tidemark.llm import words
    monkeypatch.setattr(words, "SLICE_BYTES", most)                       # a text alone, a few, all at once
    texts = ["", "\n", " a", "a ", "\na", "a\n", "a b\nC d.", "É ßx, \nÀ!!", "K 10 '' a'b"] + samples() + [t or "" for _, t in odd_rows]
    ref = library(path)
    enc = WordEncoder(path)
    assert list(enc.encode_all(pa.array(["x", *texts]).slice(1))) == [ref(t) for t in texts]
    assert list(enc.encode_all(pa.array([], pa.string()))) == []
    named = WordEncoder(path, names_are_text=False)
    assert list(named.encode_all(pa.array(texts))) == [named.encode(t) for t in texts]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_a_word_of_a_batch_is_looked_up_once(path):
    import pyarrow as pa

    class Counted(dict):
        asked = 0

        def __getitem__(self, word):
            Counted.asked += 1
            return inner[word]
    enc = WordEncoder(path)
    inner, enc._parts = enc._parts, Counted()
    texts = ["Über the hills, and\nthe hills; over the hills."] * 500
    assert list(enc.encode_all(pa.array(texts))) == [library(path)(t) for t in texts]
    assert Counted.asked <= 12


def test_cache_keeps_recent_units_when_full():
    from tidemark.llm.words import Cached
    asked = []
    c = Cached(lambda u: asked.append(u) or u.encode(), most=600)          # three of these units fill it
    for u in ("a", "b", "c", "a", "d", "a", "e", "a"):
        assert c[u] == u.encode()
    assert asked.count("a") == 1 and len(c) <= 3 and len(c.older) <= 3
    c.forget()
    assert not c and not c.older and not c.size


def test_token_files_round_trip(llm, make, odd_rows):
    folder, ref = scratch_path(llm, "t"), library(BYTES)
    index = seekable.write_token_files(make(odd_rows), folder, BYTES, frame_bytes=512)
    got = seekable.starts(seekable.read_token_files(index, folder), index).collect()
    key = lambda d, t: (d is not None, d or 0, t or "")
    want, start = [], 0
    for doc, text in sorted(odd_rows, key=lambda r: key(*r)):
        ids = ref(text) + pack([2])
        want.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in got), key=lambda r: r[1]) == want
    one = index.where("doc_id = 7")
    assert bytes(seekable.read_token_files(one, folder).first().ids) == ref(dict(odd_rows)[7]) + pack([2])


def test_empty_token_files(llm, make):
    folder = scratch_path(llm, "t")
    index = seekable.write_token_files(make([]), folder, BYTES)
    assert seekable.starts(seekable.read_token_files(index, folder)).count() == 0


class Memory:
    def __init__(self, data):
        self.data, self.reads = data, []

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        self.reads.append((at, n))
        return self.data[at:at + n]


def shard(raw, frame_bytes=100):
    import io
    out = io.BytesIO()
    w = seekable.ShardWriter(out, frame_bytes)
    w.write(raw)
    w.close()
    return out.getvalue()


def test_shard_format_and_access():
    import zstandard
    raw = random.Random(1).randbytes(1234)
    data = shard(raw)
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == raw
    frames, flags, magic = struct.unpack("<IBI", data[-9:])
    assert (frames, flags, magic) == (13, 0x80, 0x8F92EAB1)
    src = Memory(data)
    reader = seekable.ShardReader(src)
    src.reads.clear()
    assert reader.read(150, 100) == raw[150:250] and len(src.reads) == 2     # two frames, no others
    with pytest.raises(ValueError):
        reader.read(1230, 10)


def test_damage_is_found():
    import zstandard
    data = bytearray(shard(b"a" * 100 + b"b" * 100))
    reader = seekable.ShardReader(Memory(bytes(data)))
    begin, raw, offset, packed, check = reader._frames[1]
    other = zstandard.ZstdCompressor(level=3).compress(b"c" * 100)
    assert len(other) == packed
    data[offset:offset + packed] = other
    with pytest.raises(ValueError, match="checksum"):
        seekable.ShardReader(Memory(bytes(data))).read(100, 5)
    with pytest.raises(ValueError):
        seekable.ShardReader(Memory(bytes(data[:-1]) + b"\x00"))


def test_first_fit_decreasing_equals_plain_search():
    rng = random.Random(3)
    for _ in range(50):
        lengths = sorted((rng.randint(1, 50) for _ in range(rng.randint(0, 60))), reverse=True)
        room, want = [], []
        for n in lengths:
            k = next((i for i, r in enumerate(room) if r >= n), len(room))
            if k == len(room):
                room.append(50)
            want.append((k, 50 - room[k]))
            room[k] -= n
        assert packing.first_fit_decreasing(lengths, 50) == want


def test_packing_is_complete(make, odd_rows):
    ref, want = library(WORDS), {}
    parts, places = packing.pack_documents(make(odd_rows), WORDS, capacity=64, group_size=10)
    rows = parts.join(places, ["rid", "start"]).collect()
    assert len(rows) == parts.count()
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.rid, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    got = []
    for rs in docs.values():
        rs.sort(key=lambda r: r.start)
        ids = b"".join(bytes(r.ids) for r in rs)
        assert [r.start for r in rs] == [sum(x.length for x in rs[:i]) for i in range(len(rs))]
        assert all(r.length == len(r.ids) // 4 and r.doc_tokens == len(ids) // 4 for r in rs)
        got.append((rs[0].doc_id, ids))
    want = [(d, ref(t) + pack([1])) for d, t in odd_rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    for rs in seqs.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == [sum(x.length for x in rs[:i]) for i in range(len(rs))]
        assert sum(r.length for r in rs) <= 64
    whole = packing.sequences(parts, places, capacity=64, pad_id=9).collect()
    assert len(whole) == len(seqs) and all(len(r.ids) == 64 and r.ids[r.length:] == [9] * (64 - r.length) for r in whole)


def test_packing_empty_table(make):
    parts, places = packing.pack_documents(make([]), WORDS)
    assert parts.count() == places.count() == 0


def cut_and_scan(lattice, text, chunk):
    n, reach, parts = -(-len(text) // chunk), lattice.longest, []
    for k in range(n):
        begin, end = k * chunk, min(len(text), (k + 1) * chunk)
        lead = max(0, begin - reach)
        parts.append((text[lead:end + reach], begin - lead, end - lead, k == n - 1))
    ms = [pieces.load(pieces.dump(lattice.transfer(*p))) for p in parts]
    whole = ms[0]
    for m in ms[1:]:
        whole = pieces.compose(whole, m)
    return parts, pieces.best_states(ms, (0, 0), (0, 0)), whole


def test_scan_finds_the_best_path_of_a_weighted_lattice():
    """A unigram lattice (weights, no pairs, no word starts) against all segmentations."""
    weights = {"a": -2.0, "b": -2.5, "ab": -3.0, "ba": -3.9, "aba": -4.5, "bb": -4.0, "abab": -5.5}
    lattice, rng = pieces.Lattice(weights, unknown=-9.0), random.Random(7)

    def best(text):
        got = [(0.0, [])]
        for i in range(1, len(text) + 1):
            got.append(max(((got[i - n][0] + lattice.weight(text[i - n:i]), [*got[i - n][1], text[i - n:i]])
                            for n in range(1, min(4, i) + 1) if lattice.weight(text[i - n:i]) is not None), key=lambda x: x[0]))
        return got[-1]
    for _ in range(40):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 25)))
        for chunk in (1, 3, 8):
            parts, states, whole = cut_and_scan(lattice, text, chunk)
            assert whole[0, 0][0, 0] == pytest.approx(best(text)[0])
            path = [x for p, s in zip(parts, states) for x in lattice.trace(*p, *s, lambda t: [])]
            assert "".join(path) == text and sum(map(lattice.weight, path)) == pytest.approx(best(text)[0])


def test_composition_is_associative():
    lattice = pieces.model(SP).lattice
    text = "▁the▁thing▁ononerthe▁inging"
    ms = [lattice.transfer(text, b, min(b + 7, len(text)), b + 7 >= len(text)) for b in range(0, len(text), 7)]
    a, b, c = ms[:3]
    assert pieces.compose(pieces.compose(a, b), c) == pieces.compose(a, pieces.compose(b, c))


def test_pieces_equal_library(odd_rows):
    import sentencepiece
    sp, m = sentencepiece.SentencePieceProcessor(model_file=SP), pieces.model(SP)
    for text in samples() + [t or "" for _, t in odd_rows]:
        ids = array("I", sp.encode(text)).tobytes()
        assert m.encode(text) == ids, repr(text[:80])
        assert m.decode(ids) == sp.decode(sp.encode(text))
    for text in samples(250):
        marked = "▁" + text.replace(" ", "▁")
        for chunk in (1, 5, 17):
            parts, states, _ = cut_and_scan(m.lattice, marked, chunk)
            got = b"".join(m.trace(*p, *s) for p, s in zip(parts, states))
            assert not text or got == array("I", sp.encode(text)).tobytes(), (chunk, text)


def test_giant_documents(make, odd_rows):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=SP)
    got = pieces.decode(pieces.encode(make(odd_rows), SP, chunk=1000, block=3), SP).collect()
    want = [(d, array("I", sp.encode(t or "")).tobytes(), sp.decode(sp.encode(t or ""))) for d, t in odd_rows]
    assert sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in got), key=str) == sorted(want, key=str)
    assert pieces.encode(make([]), SP).collect() == []
