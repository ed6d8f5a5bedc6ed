import random

from tidemark.llm import line_dedup as L


def brute(rows, **kw):
    """First copy of every multi-line chunk stays, in the order (doc_id, row, chunk)."""
    out, seen = {}, set()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    for i in order:
        lines = (rows[i][1] or "").encode().split(b"\n")
        kept, gone = [], 0
        for a, z in L.line_chunks(lines, **kw):
            body = b"\n".join(lines[a:z])
            if z - a > 1 and body in seen:
                gone += z - a
                continue
            if z - a > 1:
                seen.add(body)
            kept += lines[a:z]
        out[i] = (rows[i][0], len(lines), gone, b"\n".join(kept).decode())
    return sorted(out.values(), key=str)


def result(df, **kw):
    return sorted(((r.doc_id, r.n_lines, r.n_removed_lines, r.text) for r in L.line_dedup(df, **kw).collect()), key=str)


def sample():
    rng = random.Random(2)
    line = lambda: "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 4)))
    shared = [[line() + str(k) for _ in range(12)] for k in range(4)]
    return [(i, "\n".join([line() for _ in range(rng.randint(0, 6))] + rng.choice(shared) + [line() for _ in range(rng.randint(0, 6))]))
            for i in range(40)]


def test_matches_brute_force(make):
    rows = sample()
    assert result(make(rows, 1)) == brute(rows)
    assert any(r[2] for r in brute(rows))


def test_odd_rows(make, odd_rows):
    rows = odd_rows + [(20, "a\nb\nc\nd"), (20, "a\nb\nc\nd"), (None, "a\nb\nc\nd"), (21, "\n\n\n"), (22, "\n\n\n")]
    assert result(make(rows, 1)) == brute(rows)
    assert result(make([])) == []


def test_chunks_cover_and_resist_shifts():
    rng = random.Random(5)
    lines = [str(rng.random()).encode() for _ in range(400)]
    chunks = L.line_chunks(lines)
    assert [a for a, _ in chunks] == [0] + [z for _, z in chunks][:-1] and chunks[-1][1] == 400
    assert all(L.LEAST <= z - a <= L.MOST for a, z in chunks[:-1])
    shifted = {tuple((b"new", b"lines", *lines)[a:z]) for a, z in L.line_chunks([b"new", b"lines", *lines])}
    assert len({tuple(lines[a:z]) for a, z in chunks} - shifted) <= 3


def test_equal_hashes_with_other_bytes(make, monkeypatch):
    """Every chunk has the same hash: only byte comparison tells them apart."""
    rows = [(i, f"l{i % 3}\nm\nn\no") for i in range(9)]
    real = L._chunker

    def colliding(args):
        run = real(args)

        def over(batches):
            import pyarrow as pa
            for b in run(batches):
                yield b.set_column(4, "hash", pa.array([1] * b.num_rows, pa.int64()))
        return over
    monkeypatch.setattr(L, "_chunker", colliding)
    assert result(make(rows, 1)) == brute(rows)
