"""Token ids of whole Arrow text columns through a memory of words."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from itertools import filterfalse
from pathlib import Path

import numpy as np
import pyarrow as pa

from ensemblescore.llm.text import text_bytes, words

#: Words in a generation of a worker's memory. It holds two; words met again move to the younger.
MOST_KNOWN = 300_000

#: Words sent to the library in one text, parted by an added token or, if of plain letters, by a space.
AT_ONCE = 512

#: Pre-tokenizer pattern whose pieces never hold white space, nor look beyond it.
_LETTERS_DIGIT_OTHER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def parts_at_spaces(model: dict) -> bool:
    """Whether a text's ids are those of its words, one after another.

    So it is where the normalizer only composes, folds white space and lowers characters one by
    one, where white space is dropped between pieces that cannot hold it, and where no added token
    looks beyond itself: nothing composes with ASCII white space, so no rule sees both sides of it.
    """
    def steps(part, inside):
        return [] if part is None else part[inside] if part["type"] == "Sequence" else [part]

    folds = all(s["type"] in ("NFC", "Lowercase")
                or s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " "
                for s in steps(model["normalizer"], "normalizers"))
    split, *rest = steps(model["pre_tokenizer"], "pretokenizers") or [{"type": None}]
    cuts = (split["type"] == "Split" and split["pattern"] == {"Regex": _LETTERS_DIGIT_OTHER}
            and split["behavior"] == "Removed" and split["invert"]
            and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in rest))
    plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \t\n\x0b\x0c\r")
                    for t in model["added_tokens"])
    return folds and cuts and plain


def plain_letters(model: dict, normalize: Callable[[str], str], alphabet: list[str]) -> str:
    """Letters whose words, lowered as ``normalize`` does, are one piece each, or "" if the model cannot tell pieces apart.

    For models that ``parts_at_spaces``: the pattern cuts no run of letters, and below U+0250 no two of them compose.
    Added tokens are in none of these words if they have ASCII punctuation. If all bytes of ``alphabet`` have an id
    inside a piece and one with the mark of its end, every piece has that mark in its last id and nowhere else."""
    bpe, mark = model["model"], model["model"].get("end_of_word_suffix") or ""
    part = model["pre_tokenizer"].get("pretokenizers", [model["pre_tokenizer"]])
    if (bpe["type"] != "BPE" or bpe.get("dropout") or bpe.get("ignore_merges") or bpe.get("continuing_subword_prefix")
            or [s["type"] for s in part] != ["Split", "ByteLevel"]
            or not all(re.search("[!-/:-@\\[-`{-~]", t) for t in [mark, *(t["content"] for t in model["added_tokens"])])
            or not all(c in bpe["vocab"] and c + mark in bpe["vocab"] for c in alphabet)):
        return ""
    return "".join(c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1 and normalize(c) == c.lower())


def _cuts(added: list[str]) -> np.ndarray:
    """By two ASCII bytes that follow each other: whether the pattern always cuts between them.

    It does between letters, digits and others, and between digits. Not so at apostrophes, which
    begin endings, and at what added tokens have besides letters and digits."""
    kind = np.array([0 if chr(c).isspace() or c >= 0x80 else 1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 3
                     for c in range(256)])
    whole = np.isin(np.arange(256), [ord(c) for c in "'" + "".join(added) if not c.isalnum() and ord(c) < 0x80])
    cut = (kind[:, None] != kind[None, :]) | (kind[:, None] == 2)
    free = (kind > 0) & ~whole
    return cut & free[:, None] & free[None, :]


def _spaced(text: pa.Array, cuts: np.ndarray) -> pa.Array:
    """The texts with a space more wherever the pattern cuts, so that fewer words are distinct."""
    data, offsets = text_bytes(text)
    if not len(data):
        return text
    moved = np.concatenate([[0], np.cumsum(cuts[data[:-1], data[1:]])]) + np.arange(len(data))
    out = np.full(moved[-1] + 1, 0x20, np.uint8)
    out[moved] = data
    ends = np.append(moved, len(out))[offsets]
    return pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out))


def _gather(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after another; they are fewer than the bytes of a slice of text."""
    after = np.cumsum(sizes, dtype=np.int32)
    return np.repeat(begin - after + sizes, sizes) + np.arange(after[-1] if len(after) else 0, dtype=np.int32)


def _texts(names: list[str], between: str) -> list[str]:
    return [between.join(names[i:i + AT_ONCE]) for i in range(0, len(names), AT_ONCE)]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint32), *[np.array(x, np.uint32) for x in lists]])


class TextEncoder:
    """A tokenizer file of the ``tokenizers`` library, opened where it is used."""

    def __init__(self, path: str):
        self.content = Path(path).read_text(encoding="utf-8")

    def __getstate__(self):
        return {"content": self.content}

    def _open(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import tokenizers

        self.model = tokenizers.Tokenizer.from_str(self.content)
        self.model.no_truncation()
        self.model.no_padding()
        rules = json.loads(self.content)
        added = [t["content"] for t in rules["added_tokens"]]
        self.by_words = parts_at_spaces(rules) and bool(added)
        if self.by_words:
            self.cuts = _cuts(added)
            self.parting, self.parting_id = rules["added_tokens"][0]["content"], rules["added_tokens"][0]["id"]
            step = tokenizers.pre_tokenizers
            letters = plain_letters(rules, self.model.normalizer.normalize_str if rules["normalizer"] else str,
                                    step.ByteLevel.alphabet())
            self.is_plain = re.compile(f"[{letters}]+" if letters else "(?!)").fullmatch
            if letters:
                # The same model on words that need no normalizer and no pattern.
                self.plain = tokenizers.Tokenizer(self.model.model)
                self.plain.pre_tokenizer = step.Sequence(
                    [step.WhitespaceSplit(), step.ByteLevel(add_prefix_space=False, use_regex=False)])
                mark = rules["model"]["end_of_word_suffix"]
                self.is_end = np.zeros(max(rules["model"]["vocab"].values()) + 1, bool)
                self.is_end[[i for t, i in rules["model"]["vocab"].items() if t.endswith(mark)]] = True
        self.older = None
        self._young()

    def _young(self):
        self.known: dict[str, int] = {}
        self.pool, self.ends = array("I"), array("i", [0])

    def _ids(self, texts: list[str], model=None) -> list[list[int]]:
        return [e.ids for e in (model or self.model).encode_batch_fast(texts, add_special_tokens=False)]

    def _slots(self, names: list[str]) -> np.ndarray:
        """Where the words stand in the pool, which learns those it does not hold."""
        if len(self.known) > MOST_KNOWN:
            self.older = (self.known, np.array(self.pool, np.uint32), np.array(self.ends, np.int32))
            self._young()
        missing = list(filterfalse(self.known.__contains__, names))
        if self.older and missing:
            known, pool, ends = self.older
            again = list(filter(known.__contains__, missing))
            slots = np.fromiter(map(known.__getitem__, again), np.int32, len(again))
            sizes = ends[slots + 1] - ends[slots]
            self._learn(again, pool[_gather(ends[slots], sizes)], sizes)
            missing = list(filterfalse(known.__contains__, missing))
        if missing:
            plain = list(filter(self.is_plain, missing))
            if plain:
                flat = _flat(self._ids([t.lower() for t in _texts(plain, " ")], self.plain))
                self._learn(plain, flat, np.diff(np.flatnonzero(self.is_end[flat]), prepend=-1))
            # Many words in a text; one that holds the token between them would part anew and goes alone.
            others = list(filterfalse(self.is_plain, missing))
            apart = [w for w in others if self.parting not in w]
            flat = _flat(self._ids([t + self.parting for t in _texts(apart, self.parting)]))
            ends = np.flatnonzero(flat == self.parting_id)
            self._learn(apart, np.delete(flat, ends), np.diff(ends, prepend=-1) - 1)
            for w in others:
                if self.parting in w:
                    ids = self._ids([w])[0]
                    self._learn([w], np.array(ids, np.uint32), np.array([len(ids)]))
        return np.fromiter(map(self.known.__getitem__, names), np.int32, len(names))

    def _learn(self, names: list[str], ids: np.ndarray, sizes: np.ndarray):
        first = len(self.ends) - 1
        self.known.update(zip(names, range(first, first + len(names))))
        self.ends.frombytes((len(self.pool) + np.cumsum(sizes)).astype(np.int32).tobytes())
        self.pool.frombytes(ids.astype(np.uint32).tobytes())

    def encode(self, text: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, each followed by ``end_id``, and the n + 1 offsets of the texts.

        ``text`` is large_string without nulls. No begin, truncation or padding; special strings
        inside a text are read as the library does by default."""
        if not hasattr(self, "model"):
            self._open()
        if not self.by_words:
            lists = self._ids(text.to_pylist())
            n = np.array([len(x) for x in lists], np.int64)
            flat = _flat(lists)
        else:
            flat_words, n_words = words(_spaced(text, self.cuts))
            coded = flat_words.dictionary_encode()
            slots = self._slots(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
            ends = np.array(self.ends, np.int32)
            begin, size = ends[slots], ends[slots + 1] - ends[slots]
            which = coded.indices.to_numpy(zero_copy_only=False)
            sizes = size[which]
            flat = np.array(self.pool, np.uint32)[_gather(begin[which], sizes)]
            after = np.cumsum(sizes)
            upto = np.concatenate([[0], after])[np.concatenate([[0], np.cumsum(n_words)])]
            n = np.diff(upto)
        offsets = np.concatenate([[0], np.cumsum(n + 1)])
        out, own = np.full(offsets[-1], end_id, np.uint32), np.ones(offsets[-1], bool)
        own[offsets[1:] - 1] = False
        out[own] = flat
        return out, offsets
