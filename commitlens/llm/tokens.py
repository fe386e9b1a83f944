"""Token ids of whole texts, with a bounded cache of words per worker."""

from __future__ import annotations

import json
import re
import struct
from itertools import compress, repeat
from operator import is_

import numpy as np
from tokenizers import Tokenizer

# Words a worker remembers; then those not met of late are forgotten. Ids never depend on it.
MAX_CACHED_WORDS = 700_000
# Words that are encoded at once.
_LEARNED_AT_ONCE = 256
# Letters that most words consist of.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100))).replace("\xf7", "")
# Stands between words that are encoded together.
_SEPARATOR = "\x01"


def default_tokenizer() -> str:
    """Path of the public word-level BPE vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _words_are_independent(tokenizer: Tokenizer) -> bool:
    """Does white space always end a token, and case never matter?

    True for a vocabulary that lower-cases and drops white space when splitting:
    then a text's ids are its words' ids, one after the other.
    """
    spec = json.loads(tokenizer.to_str())
    split, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    first = (split.get("pretokenizers") or [{}])[0]
    steps = [step.get("type") for step in normal.get("normalizers", [])]
    return (
        first.get("type") == "Split"
        and first.get("behavior") == "Removed"
        and bool(first.get("invert"))
        and r"[^\s\p{L}\p{N}]+" in str((first.get("pattern") or {}).get("Regex"))
        and set(steps) == {"NFC", "Replace", "Lowercase"}
    )


def _letters_as_split(tokenizer: Tokenizer) -> dict[int, str]:
    """How a splitter hands each of `_LETTERS` to the model; empty if more happens to words of them."""
    if tokenizer.normalizer.normalize_str(_LETTERS) != _LETTERS:
        return {}
    shown = [[piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(c)] for c in _LETTERS]
    whole = [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(_LETTERS)]
    if any(len(pieces) != 1 for pieces in shown) or whole != ["".join(pieces[0] for pieces in shown)]:
        return {}
    return {ord(c): pieces[0] for c, pieces in zip(_LETTERS, shown)}


class TextEncoder:
    """Encodes texts to little-endian uint32 id bytes, exactly as the tokenizer does.

    Where the vocabulary allows it, each distinct word is encoded once per worker, and
    words of plain letters, which are split and normalized to themselves, by the model alone;
    texts that hold special-token marks take the plain way.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _words_are_independent(self.tokenizer)
        # Words met since the last turn, and those of the turn before.
        self.ids: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        mark = self._plain([_SEPARATOR])[0]
        self.mark = np.frombuffer(mark, "<u4")[0] if len(mark) == 4 else None
        self.by_word &= self.mark is not None
        self.as_split = _letters_as_split(self.tokenizer) if self.by_word else {}
        self.letters = re.compile(f"[{_LETTERS}]+" if self.as_split else "(?!)")

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _recall(self, words: set[bytes]) -> set[bytes]:
        """Those of the words that are not remembered; the others are words met of late."""
        unknown = set()
        for word in words:
            if word not in self.ids:
                if (found := self.old.get(word)) is None:
                    unknown.add(word)
                else:
                    self.ids[word] = found
        return unknown

    def _learn(self, words: set[bytes]) -> None:
        ids, rest, ending = self.ids, [], []
        for word in words:
            if word[-1:] in (b".", b",") and (word[-2:-1].isalpha() or self.letters.fullmatch(word[:-1].decode())):
                ending.append(word)
            else:
                rest.append(word)
        bases = {word[:-1] for word in ending} | {b".", b","}
        rest.extend(self._recall(bases - words))
        odd, plain, model = [], [], self.tokenizer.model
        for word in rest:
            if self.letters.fullmatch(text := word.decode()):
                found = [token.id for token in model.tokenize(text.translate(self.as_split))]
                ids[word] = struct.pack(f"<{len(found)}I", *found)
            else:
                (odd if _SEPARATOR in text else plain).append(word)
        # A mark between words shows where each word's ids end.
        for word, found in zip(odd, self._plain([w.decode() for w in odd])):
            ids[word] = found
        for at in range(0, len(plain), _LEARNED_AT_ONCE):
            part = plain[at : at + _LEARNED_AT_ONCE]
            text = f" {_SEPARATOR} ".join(w.decode() for w in part)
            found = np.frombuffer(self._plain([text])[0], "<u4")
            cuts = np.flatnonzero(found == self.mark)
            begins = np.concatenate(([0], cuts + 1)) * 4
            ends = np.concatenate((cuts, [len(found)])) * 4
            raw = found.tobytes()
            ids.update((w, raw[b:e]) for w, b, e in zip(part, begins.tolist(), ends.tolist()))
        for word in ending:
            ids[word] = ids[word[:-1]] + ids[word[-1:]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each whole text; a null is an empty text."""
        texts = [text or "" for text in texts]
        if not self.by_word:
            return self._plain(texts)
        if len(self.ids) > MAX_CACHED_WORDS // 2:
            self.old, self.ids = self.ids, {}
        words = [text.encode().lower().split() for text in texts]
        found = [list(map(self.ids.get, ws)) for ws in words]
        unseen = [list(compress(range(len(f)), map(is_, f, repeat(None)))) for f in found]
        missing = {ws[i] for ws, at in zip(words, unseen) for i in at}
        if unknown := self._recall(missing):
            self._learn(unknown)
        for ws, f, at in zip(words, found, unseen):
            for i in at:
                f[i] = self.ids[ws[i]]
        out = [b"".join(f) for f in found]
        special = [i for i, text in enumerate(texts) if "<|" in text]
        for i, ids in zip(special, self._plain([texts[i] for i in special])):
            out[i] = ids
        return out


_encoders: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """The worker's encoder for a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = TextEncoder(path)
    return _encoders[path]


def slices(batch, rows: int = 256):
    """A record batch in pieces of few rows, so that what hangs on one stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
