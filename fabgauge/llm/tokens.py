"""Token ids of whole texts by a tokenizer file of the ``tokenizers`` library.

Words repeat, so their ids are looked up in a bounded cache. That is right only where the tokenizer
itself never joins characters across the cut; byte-level BPE with its usual pattern never does so
before a single space or line break between two other characters. Any other tokenizer, and any text
with other white space, is encoded whole.
"""

from __future__ import annotations

import json
import string
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

# Words in each of the two halves of a worker's cache, about 200 bytes each, and word endings kept.
CACHE_WORDS, CACHE_ENDINGS = 250_000, 10_000
# Words that a worker keeps from one task to the next: those met first, as nearly all common ones are.
KEPT_WORDS = 30_000
END_ID = 2
DEFAULT_TOKENIZER = "byte_bpe_50k.json"


def default_tokenizer() -> str:
    return public_tokenizers.path(DEFAULT_TOKENIZER)


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte: itself for printable
    Latin-1, and 256 upwards for the others in order."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Encodes texts as arrays of ids of the narrowest unsigned type that holds the vocabulary."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.full = Tokenizer.from_str(json.dumps(spec))
        self.full.encode_special_tokens = True
        self.dtype = id_type(self.full.get_vocab_size())
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.by_word = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and model["type"] == "BPE"
            and not model.get("dropout")
            and not model.get("ignore_merges")
        )
        self.model = self.full.model
        self.letters = _byte_letters()
        # When the newer half is full it becomes the older one, whose words move up when seen again.
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.endings: dict[str, bytes] = {}
        self.limit = cache_words

    def _piece(self, text: str) -> bytes:
        shown = text.encode().decode("latin-1").translate(self.letters)
        return self._shown_piece(shown)

    def _shown_piece(self, shown: str) -> bytes:
        ids = [token.id for token in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)

    def _ending(self, text: str) -> bytes:
        ids = self.endings.get(text)
        if ids is None:
            if len(self.endings) >= CACHE_ENDINGS:
                self.endings.clear()
            ids = self.endings[text] = self._piece(text)
        return ids

    def _whole(self, text: str) -> bytes:
        ids = self.full.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def _word(self, key: str) -> bytes | None:
        """Ids of one word with what stands before it; None if it holds other white space."""
        lead, body = (key[0], key[1:]) if key[:1] in ("\n", "\t") else (" ", key)
        if body.split() != [body]:
            return None
        stem = body.rstrip(string.punctuation)
        before = "" if lead == "\t" else lead
        plain = stem.isascii()
        if not (stem.isalpha() and (plain or max(stem) <= "ɏ")):
            return self._whole(before + body)
        # Plain letters stand for themselves.
        shown = stem if plain else stem.encode().decode("latin-1").translate(self.letters)
        ids = self._shown_piece(self.letters[ord(" ")] + shown if before == " " else shown)
        if lead == "\n":
            ids = self._ending("\n") + ids
        tail = body[len(stem) :]
        return ids + self._ending(tail) if tail else ids

    def encode(self, text: str) -> np.ndarray:
        if not self.by_word or "\t" in text:
            return np.frombuffer(self._whole(text), self.dtype)
        # A tab marks the first word, which has nothing before it.
        words = ("\t" + text.replace("\n", " \n")).split(" ") if text else []
        found = list(map(self.cache.get, words))
        if None in found:
            if len(self.cache) > self.limit:
                self.older, self.cache = self.cache, {}
            for at in [i for i, ids in enumerate(found) if ids is None]:
                word = words[at]
                ids = self.cache.get(word) or self.older.get(word) or self._word(word)
                if ids is None:
                    return np.frombuffer(self._whole(text), self.dtype)
                self.cache[word] = found[at] = ids
        joined = b"".join(found)
        return np.frombuffer(joined, self.dtype)

    def shrink(self, words: int = KEPT_WORDS) -> None:
        """Keep only so many words, when a task is over and other work may follow."""
        first = self.older if len(self.older) >= words else self.cache
        self.older, self.cache = {}, dict(islice(first.items(), words))

    def documents(self, texts: list[str | None], end_id: int = END_ID) -> Iterator[np.ndarray]:
        """Ids of each text and the end id; a null text is empty."""
        for text in texts:
            yield np.append(self.encode(text or ""), self.dtype.type(end_id))


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """The encoder that a Python worker keeps for all its tasks, with its words."""
    return Encoder(path)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 65_536 else "<u4")
