import pytest

from tidemark.llm import packing, seekable
from tidemark.llm.words import encoder, pack
from tidemark.session import scratch_path

from .test_tokens import BYTES, WORDS, samples

TEXTS = ["<|endoftext|>", "a <|endoftext|> b", "Two\n<|startoftext|>words <|endoftext|><|endoftext|>  é", "<|endoftext", "<|ENDOFTEXT|> x"]


def default(path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    return lambda t: pack(tok.encode(t or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("path,end", [(BYTES, 50256), (WORDS, 49407)])
def test_ids_equal_the_library_without_a_switch(path, end, odd_rows):
    enc, ref = encoder(path), default(path)
    assert enc.encode("<|endoftext|>") == pack([end])
    for text in TEXTS + samples() + [t or "" for _, t in odd_rows]:
        assert enc.encode(text) == ref(text), repr(text[:80])


def test_files_and_sequences_hold_added_tokens(llm, make):
    rows, folder = list(enumerate(TEXTS)), scratch_path(llm, "t")
    index = seekable.write_token_files(make(rows), folder, BYTES)
    got = {r.doc_id: bytes(r.ids) for r in seekable.read_token_files(index, folder).collect()}
    assert got == {d: default(BYTES)(t) + pack([2]) for d, t in rows}
    parts, _ = packing.pack_documents(make(rows), WORDS)
    assert {r.doc_id: bytes(r.ids) for r in parts.collect()} == {d: default(WORDS)(t) + pack([1]) for d, t in rows}
