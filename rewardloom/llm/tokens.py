"""Whole texts to ids with the tokenizers library, remembering the chunks already encoded.

Both tokenizers here split a text into pre-tokens before merging, and a pre-token never runs
across the boundaries used below, so the ids of a text are the ids of its chunks in a row:

* ``kept``: a byte-level tokenizer whose pre-tokens may begin with one space.  A space or line feed
  after a character that isn't white space always begins a pre-token.  Where white space follows
  white space, the text is cut only at a space between two other characters.
* ``dropped``: a tokenizer that drops white space and lower-cases.  It is cut at every space and
  line feed.

A special string of the tokenizer (such as an end mark) in a text is found before anything else, as written, and becomes
its one id, as in the library's plain ``encode``; the text before it and behind it are chunked each on its own.

A natural text repeats its words, so some texts at a time are cut in Arrow and each of their distinct
chunks is looked up once.  A new chunk made of letters and trailing punctuation is one pre-token
each, which goes to the tokenizer's model directly; every other new chunk goes through the whole
tokenizer.  The dictionary lives as long as the Python worker.  When it holds ``MOST`` entries it
becomes the older of two and a new one begins, which takes over the entries that are used again;
the older one before it is dropped.  Entries of over ``LONG`` characters aren't kept.  ``tests/llm``
compares the ids with the library's on fuzzed texts.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST, LONG = 300_000, 48
_TWO = re.compile(r"\s\s")
_INNER = re.compile(r"(?<=\S) (?=\S)")
# letters of ASCII and Latin-1 (composed, one lower-case letter each), then ASCII punctuation without the apostrophe
_PLAIN = re.compile("(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def _byte_names() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable Latin-1 as itself, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str, spaces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # one task, one core
        from tokenizers import Tokenizer

        if spaces not in ("kept", "dropped"):
            raise ValueError("spaces: kept or dropped")
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("special strings must be found as written")
        self.marks = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        longest_first = sorted(self.marks, key=len, reverse=True)
        self.cut_marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split
        self.model = self.tokenizer.model
        self.kept = spaces == "kept"
        self.names = _byte_names()
        self.seen: dict[str, bytes] = dict(self.marks)      # of chunks; no other chunk holds a special string
        self.older: dict[str, bytes] = {}
        self.space, self.feed = self.names[ord(" ")], self.names[ord("\n")]
        self.line = self._part("\0\n") if self.kept else b""
        odd = [re.escape(x) for x in longest_first]
        if self.kept:
            white = "".join(f"\\x{{{c:x}}}" for c in range(sys.maxunicode + 1) if chr(c).isspace())
            odd += ["\\x{0}", f"[{white}][{white}]"]
        self.odd = "|".join(odd)                            # in Arrow: texts to be cut by _chunks

    def _chunks(self, text: str) -> list[str]:
        """Keys of the text's chunks and special strings."""
        if not any(mark in text for mark in self.marks):
            return self._ordinary(text)
        keys: list[str] = []
        for i, part in enumerate(self.cut_marks(text)):
            if i % 2:
                keys.append(part)
            elif part:
                keys += self._ordinary(part)
        return keys

    def _ordinary(self, text: str) -> list[str]:
        """Keys of the chunks of a text without special strings.  ``kept``: a chunk that lost the space before it is its own key; the first
        chunk, and every chunk of a text with repeated white space (or a zero character), is written in full
        behind a zero character."""
        if not self.kept:
            return text.replace("\n", " ").split(" ")
        if "\0" in text or _TWO.search(text):
            first, *rest = _INNER.split(text)
            return ["\0" + first, *["\0 " + x for x in rest]]
        cut = text.replace("\n", " \n").split(" ")
        cut[0] = "\0" + cut[0]
        return cut

    def _part(self, key: str) -> bytes:
        """The ids of a chunk that is one pre-token."""
        ids = self.seen.get(key)
        if ids is None:
            ids = self.older.get(key)
            if ids is None:
                ids = self._spelled(key)
            if len(key) <= LONG:
                self.seen[key] = ids
        return ids

    def _spelled(self, key: str) -> bytes:
        text = self._text(key)
        if text.isascii():      # letters, marks, a space or a line feed
            named = text.replace(" ", self.space).replace("\n", self.feed)
        else:
            named = text.encode().decode("latin-1").translate(self.names)
        return array("I", [t.id for t in self.model.tokenize(named)]).tobytes()

    def _learn(self, keys: list[str]) -> list[bytes]:
        """The ids of chunks that aren't in a dictionary."""
        out, whole = [], []
        for key in keys:
            if key.isascii() and key.isalpha() and (self.kept or key.islower()):
                out.append(self._spelled(key))
                continue
            m = _PLAIN.fullmatch(key)
            if m is None:
                whole.append(len(out))
                out.append(b"")
                continue
            line, word, marks = m.groups()
            if not self.kept:
                ids = self._part(word.lower())
            else:
                ids = self.line + self._part("\0" + word) if line else self._part(word)
            if marks:
                ids += self._part("\0" + marks if self.kept else marks)
            out.append(ids)
        for i in range(0, len(whole), 20_000):
            some = whole[i:i + 20_000]
            for j, e in zip(some, self.tokenizer.encode_batch_fast([self._text(keys[j]) for j in some], add_special_tokens=False)):
                out[j] = array("I", e.ids).tobytes()
        return out

    def _text(self, key: str) -> str:
        if not self.kept:
            return key
        if key[:1] == "\0":
            return key[1:]
        return key if key[:1] == "\n" else " " + key

    def _cut(self, texts: pa.Array) -> pa.Array:
        """``_ordinary`` of many texts; none with repeated white space or a zero character, if ``kept``."""
        if not self.kept:
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        marked = pc.binary_join_element_wise(pa.scalar("\0", texts.type), pc.replace_substring(texts, "\n", " \n"), pa.scalar("", texts.type))
        return pc.split_pattern(marked, " ")

    def _ids(self, keys: list[str]) -> list[bytes]:
        """The ids of distinct chunks: looked up, taken over from the older dictionary or learned."""
        if len(self.seen) > MOST:
            self.older, self.seen = self.seen, dict(self.marks)
        ids = list(map(self.seen.get, keys))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            for i, x in zip(new, map(self.older.get, [keys[i] for i in new])):
                ids[i] = x
            unknown = [i for i in new if ids[i] is None]
            for i, x in zip(unknown, self._learn([keys[i] for i in unknown])):
                ids[i] = x
            self.seen.update(zip(keys, ids))
            for key in [x for x in keys if len(x) > LONG and x not in self.marks]:
                del self.seen[key]
        return ids

    def batch(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, self.odd)
        cut = self._cut(column.filter(pc.invert(odd)))
        cut = pa.concat_arrays([cut, pa.array([self._chunks(x) for x in column.filter(odd).to_pylist()], cut.type)])
        offsets, chunks = cut.offsets, cut.flatten().dictionary_encode()
        del column, cut
        ids = self._ids(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        spelled = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.large_binary()).take(chunks.indices))
        order = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")      # the texts' places in cut
        out: list[bytes] = [b""] * len(texts)
        for i, x in zip(order.tolist(), pc.binary_join(spelled, pa.scalar(b"", pa.large_binary())).to_pylist()):
            out[i] = x
        return out


_ENCODERS: dict = {}


def encoder(path: str, spaces: str) -> Encoder:
    """One per Python worker: a worker that is used again keeps its chunks."""
    if (path, spaces) not in _ENCODERS:
        _ENCODERS[path, spaces] = Encoder(path, spaces)
    return _ENCODERS[path, spaces]


def encoded(batches, path: str, spaces: str, end: int, most_chars: int = 8_000_000):
    """(the row's other columns, its ids with the end id as bytes) of each row of Arrow batches with a
    column text; encodes some texts at a time."""
    enc, tail = encoder(path, spaces), array("I", [end]).tobytes()
    for batch in batches:
        text = batch.column("text").to_pylist()
        other = [batch.column(i).to_pylist() for i, c in enumerate(batch.schema.names) if c != "text"]
        rows = list(zip(*other))
        i = 0
        while i < len(text):
            j, n = i, 0
            while j < len(text) and (j == i or n < most_chars):
                n += len(text[j] or "")
                j += 1
            for row, ids in zip(rows[i:j], enc.batch([x or "" for x in text[i:j]])):
                yield row, ids + tail
            i = j
