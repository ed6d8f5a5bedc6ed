import random

from tidemark.llm import line_dedup as L
from tidemark.llm.queries import op1_line_dedup

from .test_line_dedup import sample


def brute(rows, words=L.WORDS):
    """Every window of two lines and every multi-line chunk is looked up in the rows before it."""
    out, seen = {}, set()
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    for i in order:
        lines = (rows[i][1] or "").encode().split(b"\n")
        again, held, kept = [False] * len(lines), [False] * len(lines), []
        for a in range(len(lines) - 1):
            again[a] = (0, *lines[a:a + 2]) in seen
            seen.add((0, *lines[a:a + 2]))
        for a, z in L.line_chunks(lines):
            if z - a > 1:
                held[a] = (1, *lines[a:z]) in seen
                seen.add((1, *lines[a:z]))
        a = 0
        while a < len(lines):
            z = a
            while again[z]:
                z += 1
            if not (z > a and (any(held[a:z + 1]) or sum(map(L._words, lines[a:z + 1])) > words)):
                kept += lines[a:z + 1]
            a = z + 1
        out[i] = (rows[i][0], len(lines), len(lines) - len(kept), b"\n".join(kept).decode())
    return sorted(out.values(), key=str)


def result(df, **kw):
    return sorted(((r.doc_id, r.n_lines, r.n_removed_lines, r.text) for r in L.passage_dedup(df, **kw).collect()), key=str)


def test_matches_brute_force(make, odd_rows):
    rows = sample() + [(50 + k, t) for k, (_, t) in enumerate(sample()[:5])]
    odd = odd_rows + [(20, "a\nb\nc\nd"), (20, "a\nb\nc\nd"), (None, "a\nb\nc\nd"), (21, "\n\n\n\n"), (22, "\n\n\n"), (23, "中" * 200 + "\nx\ny"), (24, "z\n" + "中" * 200 + "\nx")]
    for some in (rows, odd):
        for words in (L.WORDS, 3):
            assert result(make(some, 1), words=words) == brute(some, words)
    assert result(make([])) == []


def planted(each=15):
    """Documents of few lines; passages of 2 to 8 lines and over 50 words, each in two of them at any place."""
    rng = random.Random(9)
    line = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(26, 40)))
    texts, where = [], []
    for size in range(2, 9):
        for _ in range(each):
            passage = [line() for _ in range(size)]
            for copy in range(2):
                before, after = ([line() for _ in range(rng.randint(0, 3))] for _ in range(2))
                texts.append("\n".join(before + passage + after))
                where.append((size, copy, "\n".join(before + after)))
    return list(enumerate(texts)), where


def test_recall_of_planted_passages(llm, make, tmp_path):
    """All lines of all planted passages go, and no other line; chunks alone miss most of them."""
    rows, where = planted()
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    removed = {r.doc_id: r.n_removed_lines for r in op1_line_dedup(llm, str(tmp_path)).collect()}
    assert [removed[d] for d, _ in rows] == [size * copy for size, copy, _ in where]
    left = {r.doc_id: r.text for r in L.passage_dedup(make(rows)).collect()}
    assert all(left[d] == (rest if copy else text) for (d, text), (_, copy, rest) in zip(rows, where))


def test_a_repeated_chunk_is_extended_and_short_runs_without_one_stay():
    lines = [b"%d" % k for k in range(10)]
    chunks = [(0, 3), (3, 5), (5, 8), (8, 10)]
    assert L.runs(lines, chunks, {1}, {2, 3, 4, 7}) == [(2, 6)]
    assert L.runs(lines, chunks, set(), {2, 3, 4, 7}) == []
    assert L.runs(lines, chunks, set(), {2, 3, 4, 7}, words=1) == [(2, 6), (7, 9)]
