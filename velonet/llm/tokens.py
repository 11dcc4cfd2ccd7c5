"""Token ids of whole texts by a public tokenizer file, fast: a word is encoded once per worker.

For texts of Latin letters, digits, marks and blanks (nearly all) the pre-tokens of the word-level vocabulary used here are
known: runs of letters in lower case, single digits, runs of marks. Each ends with an id that ends a word, so new ones go
to the library many in one string and their ids are told apart by these; known ones are looked up. Texts with any other
character, or with ' or <, which can begin longer pre-tokens, go to the library as they are. Tests compare both with it.

This holds for files that normalise and split as that vocabulary does; texts go to the library for any other file.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np

WORD_BPE = "word_bpe_49k.json"
#: Words kept per worker; past it, the cache starts anew. Bounds a worker's memory to about 100 MB.
CACHED = 450_000
#: Texts that are split at a time.
SLICE = 256

#: SHA-256 of what decides about normalising and splitting in the file that the fast way was proved for.
PROVED = "06e475038638a09842d86cd5fde894ab378cf78427759b78bbb39eb31de6a089"
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")
_OTHER = re.compile(r"[^ \n!-&(-;=-~À-ÖØ-öø-ÿ]")
_encoders: dict[str, Encoder] = {}


class Encoder:
    """encode_batch(texts): each text's ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model = {k: v for k, v in file["model"].items() if k not in ("vocab", "merges")}
        rules = json.dumps([file["normalizer"], file["pre_tokenizer"], model, file["added_tokens"]], sort_keys=True)
        self.fast = hashlib.sha256(rules.encode()).hexdigest() == PROVED
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, new: list[str]) -> None:
        for k in range(0, len(new), 2000):
            part = new[k : k + 2000]
            ids = self._ids(" ".join(part))
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(part):
                data = ids.tobytes()
                self.words.update(zip(part, map(data.__getitem__, map(slice, [0, *cuts[:-1]], cuts)), strict=True))
            else:
                self.words.update((w, self._ids(w).tobytes()) for w in part)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if not self.fast:
            return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out = []
        for k in range(0, len(texts), SLICE):
            part = texts[k : k + SLICE]
            pieces = [None if _OTHER.search(t) else _PIECES.findall(t.lower()) for t in part]
            if len(self.words) > CACHED:
                self.words.clear()
            self._learn(list(set().union(*filter(None, pieces)).difference(self.words)))
            get = self.words.__getitem__
            out += [self._ids(t).tobytes() if p is None else b"".join(map(get, p)) for t, p in zip(part, pieces, strict=True)]
        return out


def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(WORD_BPE)
