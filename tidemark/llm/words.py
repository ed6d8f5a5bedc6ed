"""Word-memoised encoding with the public tokenizer files.

Both vocabularies cut a text into words before they merge, and no merge crosses
a word; the ids of a text are the ids of its words in order.  Words repeat, so a
worker keeps the ids of the words it has met and asks the tokenizers library for
the others only.  The memory is bounded in bytes, and a worker that goes on to another stage forgets it.
A batch of texts is cut into words and put together from their ids by Arrow; Python sees each different word of a slice once.
"""
from __future__ import annotations

import os
import re
import weakref
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The Unicode White_Space characters (fixed values).
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNIT = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_OTHER = re.compile(f"[{_WS}]".replace(" ", "").replace("\t-\r", "\t\x0b-\r"))
# One run of Latin-1 letters, then perhaps ASCII punctuation (no apostrophe): always two separate words.
_LETTERS, _MARKS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff", "!-&(-/:-@\\[-`{-~"
_TAIL = ".,;:!?%$&*#|)\"-"                        # marks of _MARKS that words end in most often
_PLAIN = re.compile(f"( ?[{_LETTERS}]+)([{_MARKS}]*)")
_EACH_LETTER = "".join(c for c in map(chr, range(256)) if re.match(f"[{_LETTERS}]", c))

SLICE_BYTES = 16 << 20                         # of text whose words are told apart at once; a longer text is a slice of its own

CACHE_BYTES = 64 << 20                         # of one generation of a memory
PARTS = 2                                      # the memory of words without marks holds so many times more: the others meet rare units only
_ENTRY = 220                                   # a short unit, a short result and their place in a dictionary

_memories: list[weakref.ref] = []
_stage = None


def start_task() -> None:
    """To be called when a task begins: memories filled in another stage are emptied."""
    global _stage
    from pyspark import TaskContext
    now = TaskContext.get()
    if now is not None and now.stageId() != _stage:
        _stage = now.stageId()
        for ref in list(_memories):
            one = ref()
            if one is None:
                _memories.remove(ref)
            else:
                one.forget()


class Cached(dict):
    """Unit → what ``encode`` gives for it; those met recently, in two generations of at most ``most`` bytes.

    A full memory becomes the older generation, from which units that are met again return.
    """

    def __init__(self, encode, most: int = CACHE_BYTES):
        super().__init__()
        self.encode, self.most, self.size, self.older = encode, most, 0, {}
        _memories.append(weakref.ref(self))

    def forget(self) -> None:
        self.clear()
        self.size, self.older = 0, {}

    def __missing__(self, unit: str) -> bytes:
        got = self.older.pop(unit, None)
        if got is None:
            got = self.encode(unit)
            if len(unit) > 64:
                return got
        if self.size >= self.most:
            self.older = dict(self)
            self.clear()
            self.size = 0
        self.size += _ENTRY + len(unit) + (len(got) if isinstance(got, bytes) else 8)
        self[unit] = got
        return got


_ID = attrgetter("id")


def _strings(a: pa.Array) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()


def pack(ids) -> bytes:
    a = array("I", ids)
    return a.tobytes()


class WordEncoder:
    """Ids of whole texts by the tokenizer in ``path``; ``spaced``: white space belongs to the words after it.

    ``names_are_text``: the added tokens' names in a text are ordinary text; else they are the
    tokens themselves, as the library has it unless told otherwise.
    """

    def __init__(self, path: str, names_are_text: bool = True):
        from tokenizers import Tokenizer, pre_tokenizers
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True       # words are asked for as ordinary text
        self._tok = tok
        self._whole = None if names_are_text else Tokenizer.from_file(path)
        self._added = () if names_are_text else tuple(t.content for t in tok.get_added_tokens_decoder().values())
        self.spaced = bool(pack(tok.encode("a b", add_special_tokens=False).ids) !=
                           pack(tok.encode("a  b", add_special_tokens=False).ids))
        one = lambda s: pack(tok.encode(s, add_special_tokens=False).ids)
        # A single word needs no cutting: it goes to the library's merges at once, in its byte alphabet.
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        byte_names = {c: alphabet.pre_tokenize_str(chr(c))[0][0] for c in range(32, 256)}
        merges, lower = tok.model, not self.spaced

        mark = byte_names[32]

        def word(part: str) -> bytes:
            if lower:
                part = part.lower()
            if part.isascii():                 # only the blank has another name
                name = mark + part[1:] if part[0] == " " else part
            else:
                name = part.translate(byte_names)
            return array("I", map(_ID, merges.tokenize(name))).tobytes()
        parts = self._parts = Cached(word, PARTS * CACHE_BYTES)

        def split(unit: str, space: str = "") -> bytes:
            core = unit.rstrip(_TAIL)
            if core.isalpha() and core.isascii():
                return parts[space + core] + parts[unit[len(core):]] if len(core) < len(unit) else parts[space + core]
            m = _PLAIN.fullmatch(unit)
            return (parts[space + m[1]] + (parts[m[2]] if m[2] else b"")) if m else one(space + unit)
        self._first = Cached(split)                                       # a unit as it stands
        if self.spaced:
            self._after = Cached(lambda unit: split(unit, " "))           # a unit after one space
            self._newline = one("\n")

    @staticmethod
    def _unusual(text: str) -> bool:
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return True
        if text.isascii():
            return "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text
        return _OTHER.search(text) is not None

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as ``encode`` gives them."""
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
            yield from self._slice(texts.slice(at, upto - at))
            at = upto

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        odd = {i: t for i, t in enumerate(_strings(texts))
               if (self.spaced and self._unusual(t)) or any(name in t for name in self._added)}
        lines, wide = texts.cast(pa.large_string()), lambda s: pa.scalar(s, pa.large_string())
        if self.spaced:                        # a unit that begins a line begins with its break; the text's first one with a break too many
            lines = pc.binary_join_element_wise(wide("\n"), pc.replace_substring(lines, "\n", " \n"), wide(""))
        else:
            lines = pc.replace_substring(lines, "\n", " ")
        if odd:
            lines = pc.if_else(pa.array([i in odd for i in range(len(texts))]), wide(""), lines)
        cut = pc.split_pattern(lines, " ")
        units = cut.flatten().dictionary_encode()
        ids = self._units(units.dictionary).take(units.indices)
        del lines
        place = np.r_[0, np.cumsum(pc.binary_length(ids).to_numpy(zero_copy_only=False))][cut.offsets.to_numpy()].tolist()
        data, drop = memoryview(ids.buffers()[2] or b""), len(self._newline) if self.spaced else 0
        for i in range(len(texts)):
            yield self.encode(odd[i]) if i in odd else bytes(data[place[i] + drop:place[i + 1]])

    def _units(self, units: pa.Array) -> pa.Array:
        """The ids of different units: words of Latin-1 letters with marks after them by their two parts, others as a whole."""
        kind, none, wide = pa.large_binary(), pa.scalar(b"", pa.large_binary()), lambda s: pa.scalar(s, pa.large_string())
        if self.spaced:
            begins = pc.starts_with(units, "\n")
            named = pc.if_else(begins, pc.ascii_ltrim(units, "\n"), pc.binary_join_element_wise(wide(" "), units, wide("")))
        else:
            named = units
        core = pc.ascii_rtrim(named, _TAIL)
        usual = pc.match_substring_regex(core, rf"\A ?[{_LETTERS}]+\z")
        core = core.filter(usual)
        core = (core if self.spaced else pc.utf8_lower(core)).dictionary_encode()
        marks = pc.utf8_ltrim(named.filter(usual), " " + _EACH_LETTER).dictionary_encode()
        parts = self._parts
        both = [pa.array([parts[c] for c in _strings(core.dictionary)], kind).take(core.indices),
                pa.array([parts[m] if m else b"" for m in _strings(marks.dictionary)], kind).take(marks.indices)]
        if self.spaced:
            both.insert(0, pc.if_else(begins.filter(usual), pa.scalar(self._newline, kind), none))
            others = [self._newline + self._first[u[1:]] if u[:1] == "\n" else self._after[u]
                      for u in _strings(units.filter(pc.invert(usual)))]
        else:
            others = [self._first[u] if u else b"" for u in _strings(units.filter(pc.invert(usual)))]
        at = usual.to_numpy(zero_copy_only=False)
        order = np.empty(len(units), np.int64)
        order[at], order[~at] = np.arange(at.sum()), at.sum() + np.arange(len(others))
        return pa.concat_arrays([pc.binary_join_element_wise(*both, none), pa.array(others, kind)]).take(pa.array(order))

    def encode(self, text: str) -> bytes:
        for name in self._added:
            if name in text:                   # rare: the library cuts such a text at the tokens itself
                return pack(self._whole.encode(text, add_special_tokens=False).ids)
        if not self.spaced:
            first = self._first
            return b"".join([first[u] for u in text.replace("\n", " ").split(" ") if u])
        if self._unusual(text):                # runs of white space, or other than blank and line break: general cut
            first = self._first
            return b"".join([first[u] for u in _UNIT.findall(text)])
        first, after = self._first, self._after
        lines = []
        for line in text.split("\n"):
            units = line.split(" ")
            lines.append(first[units[0]] + b"".join([after[u] for u in units[1:]]) if units[0] or len(units) > 1 else b"")
        return self._newline.join(lines)


def located(path: str) -> str:
    """A vocabulary file's place on this machine: a bare name is one of the public tokenizers' package, which every worker has of its own."""
    if os.path.dirname(path):
        return path
    import public_tokenizers
    return public_tokenizers.path(path)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a file (kept between tasks, its cache between those of a stage): ids are those of the library's default."""
    start_task()
    if path not in _encoders:
        _encoders[path] = WordEncoder(located(path), names_are_text=False)
    return _encoders[path]
