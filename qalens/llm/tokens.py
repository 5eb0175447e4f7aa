"""Token ids by the ``tokenizers`` library, each space-separated word encoded once while a worker remembers it.

The ids of a text are the ids of its pieces in order wherever every cut falls between two pre-tokens. Pieces are
kept per Python worker in a bounded table, so the library only sees words that the worker has not met lately.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

#: Words in each of the two generations of a worker's table (about 200 bytes a word).
GENERATION = 500_000

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_ENDS = frozenset(".,;:!?")


class _Words(dict):
    """Word -> id bytes; a full generation becomes the old one, and words met again move to the young one."""

    def __init__(self, encode):
        self.encode, self.old = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        return ids

    def turn_over(self) -> None:
        if len(self) > GENERATION:
            self.old = dict(self)
            self.clear()


class TextTokenizer:
    """Encodes texts to little-endian uint32 bytes: ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    A byte-level pre-tokenizer attaches a space to the word after it, so text may be cut before a space that
    follows a non-space. A pre-tokenizer that drops white space lets it be cut at spaces and newlines. Texts where
    neither is certain, and every tokenizer of another kind, go to the library whole. Within a piece, a run of
    letters, one closing mark after it and a newline between words are pre-tokens of their own; a run of letters
    goes straight to the library's BPE model, all else to the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        pre, added = config.get("pre_tokenizer") or {}, config.get("added_tokens") or []
        steps = [s.get("type") for s in (config.get("normalizer") or {}).get("normalizers", [])]
        parts = pre.get("pretokenizers") or [{}]
        marked = all(re.search(r"[^\w\s.,;:!?]", t["content"]) and not re.search(r"\s", t["content"])
                     and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in added)
        known = marked and not any(config.get(k) for k in ("post_processor", "truncation", "padding")) and config["model"]["type"] == "BPE"
        self.byte_level = bool(known and pre.get("type") == "ByteLevel" and pre.get("use_regex")
                               and not pre.get("add_prefix_space") and not config.get("normalizer"))
        self.word = bool(known and steps == ["NFC", "Replace", "Lowercase"] and len(parts) == 2
                         and parts[0].get("behavior") == "Removed" and parts[0].get("invert")
                         and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in (parts[0].get("pattern") or {}).get("Regex", "")
                         and parts[1].get("type") == "ByteLevel" and not parts[1].get("use_regex"))
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte-level alphabet: other bytes follow at 256
        self.alphabet = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in printable)}
        self.words = _Words(self._spaced if self.byte_level else self._piece)
        self.heads = _Words(self._piece)

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` as little-endian uint32 bytes."""
        if self.byte_level:
            if _SPACE_AFTER_SPACE.search(text):
                ids = b"".join(map(self.heads.__getitem__, re.split(r"(?<=\S)(?= )", text)))
            else:
                head, *rest = text.split(" ")
                ids = self.heads[head] + b"".join(map(self.words.__getitem__, rest))
        elif self.word:
            ids = b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))
        else:
            return self._library(text)
        self.words.turn_over()
        self.heads.turn_over()
        return ids

    def encode_column(self, texts) -> list[bytes]:
        """``encode`` of every text of an Arrow array of strings without nulls.

        Byte-level: all texts are split at once and every distinct word of them is looked up once; the ids are gathered by
        Arrow. A text with a space after white space goes through ``encode``.
        """
        if not self.byte_level or not len(texts):
            return [self.encode(text) for text in texts.to_pylist()]
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split = pc.split_pattern(texts, " ")
        pieces = split.flatten().dictionary_encode()
        words, at = pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), pieces.indices.to_numpy().astype(np.int64)
        ends = np.cumsum(pc.list_value_length(split).to_numpy().astype(np.int64))
        starts = np.concatenate(([0], ends[:-1]))
        spaced = np.array([not w or w[-1].isspace() for w in words])[at]  # a space follows white space, unless the piece is the last
        spaced[ends - 1] = False
        odd = np.logical_or.reduceat(spaced, starts)
        inner = ~np.repeat(odd, ends - starts)
        heads = at[starts]
        inner[starts] = False
        used = np.zeros(len(words), dtype=bool)
        used[at[inner]] = True
        ids = [self.words[w] if u else b"" for w, u in zip(words, used.tolist())]
        at[starts] = len(words) + np.arange(len(texts))
        ids += [b"" if o else self.heads[words[h]] for h, o in zip(heads.tolist(), odd.tolist())]
        self.words.turn_over()
        self.heads.turn_over()
        found = pa.array(ids, pa.large_binary()).take(pa.array(at))
        edges = np.frombuffer(found.buffers()[1], dtype=np.int64)[found.offset:found.offset + len(found) + 1]
        data = memoryview(found.buffers()[2]) if found.buffers()[2] is not None else memoryview(b"")
        return [self.encode(texts[i].as_py()) if o else bytes(data[lo:hi])
                for i, (o, lo, hi) in enumerate(zip(odd.tolist(), edges[starts].tolist(), edges[ends].tolist()))]

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _spaced(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():
                return self._model("\u0120" + word)  # the byte-level form of a space
            if len(word) > 1 and word[-1] in _ENDS and word[:-1].isalpha():
                return self.words[word[:-1]] + self.heads[word[-1]]
        return self._piece(" " + word)

    def _model(self, mapped: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(mapped)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        if self.byte_level:
            cut = piece.find("\n")
            if 0 < cut < len(piece) - 1 and not piece[cut - 1].isspace() and not piece[cut + 1].isspace():
                return self._piece(piece[:cut]) + self.heads["\n"] + self.heads[piece[cut + 1:]]
        if len(piece) > 2 and piece[-1] in _ENDS and piece[-2].isalpha():
            core = piece[:-1]
            known = self.words[core[1:]] if self.byte_level and core[0] == " " else self.heads[core]
            return known + self.heads[piece[-1]]
        letters = piece[1:] if self.byte_level and piece[:1] == " " else piece
        if letters.isalpha() and (letters.isascii() or max(letters) < "ɐ" and "İ" not in letters):
            if self.word:
                piece = piece.lower()
            return self._model(piece if self.word and piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet))
        return self._library(piece)


@lru_cache(maxsize=4)
def text_tokenizer(path: str) -> TextTokenizer:
    """One tokenizer per file and worker process; its table of words lives on between tasks."""
    return TextTokenizer(path)
