"""Exact piecewise tokenization with public vocabulary files.

A text is cut at places where no token can cross (safe boundaries), so the tokens of the text
are the tokens of its pieces in order. Distinct pieces are encoded once by the library and kept
in a cache of the Python worker, bounded in bytes; words recur far more often than texts do, so
pieces over ``CACHED_PIECE`` bytes are not kept.

* ``words``: the tokenizer drops white space and no token reaches across it, so the pieces are the
  runs between ASCII white space. Runs over ``LONG_PIECE`` bytes are cut further, after a digit or
  between a letter and a mark, where the file's own pattern ends a token at both.
* ``spaced``: a byte-level tokenizer glues one leading space to a word, so a piece starts at a
  space, and each line feed is a piece of its own. Texts with runs of three or more white-space
  characters, two at the end, white space beyond ASCII, or a special string are encoded whole.
* ``whole``: any other file; texts are encoded as they are.

A byte-level tokenizer may come with its rank file (``ranks_path``), the same vocabulary for the ranks
library, which encodes whole texts several times as fast and gives the same ids. Texts with special
strings or very long runs still go through the tokenizer file, which remains the reference.

The path of a file is a parameter; nothing is copied or trained.
"""

from __future__ import annotations

import base64
import json
import os
import re
import sys
from array import array

import numpy as np
import regex

CACHE_BYTES = 192 << 20  # pieces, results and their overhead kept by a worker, whatever the size of the corpus
PIECE_OVERHEAD = 160    # of a dictionary entry and its two objects
CACHED_PIECE = 256
LONG_PIECE = 1 << 12
_LOADED: dict[tuple, "Pieces"] = {}

_ODD = re.compile(rb"[\s\x1c-\x1f]{3}|[\s\x1c-\x1f]{2}\Z|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|<\|")


_MARKS = "./,;:_+=&?%-!$#*)"
_TAIL = b".,;:!?$%&#*)"  # marks that often end a word
_LETTERS = re.compile("[a-zß-öø-ÿ]+")  # lower case, and no normal form changes them
_LONG_CUT = re.compile(rb".{%d,}?(?:[0-9]|[A-Za-z](?=[./,;:_+=&?%%-]))" % LONG_PIECE, re.S)
LONG_RUN = 1000
#: the pattern that splits a text before the merges of the rank files (a fixed value)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RARE_SPACE = b"\t\r\v\f\x1c\x1d\x1e\x1f"


def _plain(raw: bytes) -> bool:
    """A quick sufficient test for what ``_ODD`` excludes: only single spaces and line feeds, no lead byte of other white space."""
    return not (b"  " in raw or b"\n\n" in raw or b" \n" in raw or b"\n " in raw or b"<|" in raw or len(raw.translate(None, _RARE_SPACE)) != len(raw)
                or not raw.isascii() and (b"\xc2" in raw or b"\xe1" in raw or b"\xe2" in raw or b"\xe3" in raw))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _long_run(raw: bytes) -> bool:
    """Whether a word or a run of white space is so long that matching by ranks could take more than linear time."""
    return len(raw) >= LONG_RUN and (max(map(len, raw.split()), default=0) >= LONG_RUN or b" " * LONG_RUN in raw or b"\n" * LONG_RUN in raw or b"\t" * LONG_RUN in raw)


def _packed(ids) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def _byte_letters() -> dict[int, int]:
    """The letter of every byte in a byte-level vocabulary: printable bytes are themselves, the others follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in printable)}


class Pieces:
    """Encodes texts given as UTF-8 bytes; ``lengths`` counts tokens, ``ids`` returns them as packed uint32."""

    def __init__(self, path: str, count_only: bool, ranks_path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.path, self.count_only, self.cache, self.held, self.ranks = path, count_only, {}, 0, None
        self.lower = self.cut_long = False
        self.tail, self.model = b".,", None
        if ranks_path:  # the tokenizer file is loaded when the first odd text comes
            import tiktoken
            self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
        else:
            self._load()

    def _load(self) -> None:
        self.encode, self.cut = None, "whole"
        if self.path.endswith(".model"):
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=self.path)
            self.encode = lambda texts: sp.encode(texts, num_threads=1)
            return
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(self.path)
        if self.count_only:  # lengths of the encodings only: the ids never become Python lists
            self.encode = lambda texts: tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        else:
            self.encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        self.cut = self._boundaries(spec)
        if self.cut == "words":
            norm = spec.get("normalizer") or {}
            self.lower = any(s.get("type") == "Lowercase" for s in norm.get("normalizers", [norm]))
            self.cut_long = self._cuts_long(self._split_pattern(spec))
            if self.cut_long:
                self.tail = _TAIL
            if self._word_is_token(spec):
                self.model, self.to_letters = tokenizer.model, _byte_letters()

    @staticmethod
    def _split_pattern(spec: dict) -> str | None:
        """The pattern whose matches are the only text that a file's splitting step keeps, if there is one."""
        pre = spec.get("pre_tokenizer") or {}
        for s in pre.get("pretokenizers", [pre]):
            if s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert"):
                return (s.get("pattern") or {}).get("Regex")
        return None

    @staticmethod
    def _drops_space(pattern: str) -> bool:
        """Whether no match of ``pattern`` holds ASCII white space or looks beyond its own text."""
        if "(?" in pattern or "\\b" in pattern or "^" in pattern.replace("[^", "") or "$" in pattern:
            return False
        compiled = regex.compile(pattern)
        return not any(c in m.group() for c in " \t\n\v\f\r" for a in ("a", "1", ".", "'", c, "é") for b in ("a", "1", ".", "s", c) for m in compiled.finditer(a + c + b))

    @staticmethod
    def _cuts_long(pattern: str) -> bool:
        """Whether ``pattern`` ends a match after every digit and between a letter and a mark."""
        compiled = regex.compile(pattern)

        def ends(text):
            return {m.end() for m in compiled.finditer(text)}

        return all(2 in ends(f"a1{x}b") for x in "2a'" + _MARKS) and all(1 in ends(f"a{x}{y}") for x in _MARKS for y in "a1'.")

    @classmethod
    def _word_is_token(cls, spec: dict) -> bool:
        """Whether a word of ``_LETTERS`` reaches the merges as it is, its bytes as letters: then the library's merge
        model takes it directly, without normalizing, splitting and aligning it first."""
        norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers", [pre])
        compiled = regex.compile(cls._split_pattern(spec))
        return ((spec.get("model") or {}).get("type") == "BPE" and not spec["model"].get("dropout")
                and all(s.get("type") in ("NFC", "Lowercase") or s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} for s in norm.get("normalizers", [norm]))
                and len(steps) == 2 and steps[1].get("type") == "ByteLevel" and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex")
                and all(compiled.fullmatch(w) for w in ("a", "s", "abz", "sé", "ßäÿ")))

    @classmethod
    def _boundaries(cls, spec: dict) -> str:
        pre = spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers", [pre])
        pattern = cls._split_pattern(spec)
        if pattern and cls._drops_space(pattern):
            return "words"
        if len(steps) == 1 and steps[0].get("type") == "ByteLevel" and not steps[0].get("add_prefix_space") and not spec.get("normalizer"):
            return "spaced"
        return "whole"

    def pieces(self, raw: bytes) -> list[bytes]:
        if self.cut == "words":
            if self.lower and raw.isascii() and b"<|" not in raw:  # far fewer distinct words
                raw = raw.lower()
            words = raw.split()
            if self.cut_long and len(raw) > LONG_PIECE and max(map(len, words), default=0) > LONG_PIECE:
                words = [p for w in words for p in (self._shorter(w) if len(w) > LONG_PIECE else (w,))]
            return words
        if self.cut == "spaced" and (_plain(raw) or not _ODD.search(raw)):
            return raw.replace(b" ", b"\xff ").replace(b"\n", b"\xff\n\xff").split(b"\xff")
        return [raw]

    @staticmethod
    def _shorter(word: bytes) -> list[bytes]:
        if b"<|" in word:  # a special string may stand there
            return [word]
        out = _LONG_CUT.findall(word)
        rest = word[sum(map(len, out)):]
        return out + [rest] if rest else out

    def _parts(self, piece: bytes) -> tuple[bytes, bytes]:
        """A piece as two that tokenize on their own: a word and the full stops or commas after it. Where the tokenizer
        lower-cases, an ASCII word is looked up in lower case."""
        word = piece.rstrip(self.tail)
        # the token ends with an ASCII letter or digit, or a letter from U+00C0 to U+00FF (all but the signs at D7 and F7)
        if not (word[-1:].isalnum() or self.cut_long and word[-2:-1] == b"\xc3" and word[-1] not in (0x97, 0xB7)):
            word = piece
        tail = piece[len(word):]
        if self.lower and word.isascii() and b"<|" not in word:
            word = word.lower()
        return word, tail

    def _pack(self, ids) -> int | bytes:
        return len(ids) if self.count_only else _packed(ids)

    def _encoded(self, words: list[str]) -> list:
        if self.model is None:
            return list(map(self._pack, self.encode(words)))
        plain = _LETTERS.fullmatch
        rest = iter(self.encode([w for w in words if not plain(w)]))
        tokens, letters = self.model.tokenize, self.to_letters
        return [self._pack([t.id for t in tokens(w if w.isascii() else w.encode().decode("latin-1").translate(letters))] if plain(w) else next(rest)) for w in words]

    def _all(self, texts: list[bytes], join) -> list:
        cut = [self.pieces(t) for t in texts]
        cache = self.cache
        new = set().union(*cut) - cache.keys()
        added = []
        if new:
            parts = {p: self._parts(p) for p in new} if self.cut != "whole" else {p: (p, b"") for p in new}
            unknown = list({w for pair in parts.values() for w in pair} - cache.keys())
            cache.update(zip(unknown, self._encoded([w.decode("utf-8", "replace") for w in unknown])))
            for piece, (word, tail) in parts.items():
                if tail or word != piece:
                    cache[piece] = cache[word] + cache[tail]
            added = {*unknown, *new}
        out = [join(map(cache.__getitem__, c)) for c in cut]
        for piece in added:  # keep the first, mostly frequent pieces; memory stays bounded
            size = len(piece) + PIECE_OVERHEAD + (0 if self.count_only else len(cache[piece]))
            if len(piece) > CACHED_PIECE or self.held + size > CACHE_BYTES:
                del cache[piece]
            else:
                self.held += size
        return out

    def lengths(self, texts: list[bytes]) -> list[int]:
        return self._all(texts, sum)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if self.ranks is None:
            return self._all(texts, b"".join)
        odd = [i for i, t in enumerate(texts) if b"<|" in t or _long_run(t)]
        if odd and not hasattr(self, "encode"):
            self._load()
        out = [b""] * len(texts)
        for i, ids in zip(odd, self._all([texts[i] for i in odd], b"".join) if odd else ()):
            out[i] = ids
        for i in set(range(len(texts))).difference(odd):
            out[i] = self.ranks.encode_to_numpy(texts[i].decode("utf-8", "replace"), disallowed_special=()).astype("<u4").tobytes()
        return out


def pieces_for(path: str, count_only: bool, ranks_path: str | None = None) -> Pieces:
    """The worker's encoder for ``path``, loaded once per Python worker."""
    key = (path, count_only, ranks_path)
    if key not in _LOADED:
        _LOADED[key] = Pieces(path, count_only, ranks_path)
    return _LOADED[key]
