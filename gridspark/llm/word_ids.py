"""Ids of texts by the tokenizers library, each distinct word asked for once."""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a worker remembers; when there are more, it keeps those of the last texts.
MEMO_WORDS = 600_000

#: White space other than a space and a line end: all that Python or Unicode count as such.
SPACES = [chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \n"]


#: Before a text's first word and before a mark in the table of words: they have no space before them.
HEAD, MARK = "\x02", "\x01"


@cache
def tokenizer(path: str):
    """A tokenizers file as it is, but for truncation and padding, and offsets that keep spaces."""
    from tokenizers import Tokenizer
    from tokenizers.processors import ByteLevel

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    if loaded.post_processor is None:
        loaded.post_processor = ByteLevel(trim_offsets=False)
    return loaded


class WordIds:
    """Ids of texts, word by word: each distinct word goes to the library once, if remembered.

    Words begin before a space or line end that follows something else, and before a mark that
    follows a letter. There every pre-token ends, and what comes after does not depend on what came
    before, so the ids of a text are those of its words in order. Texts with other white space than
    single spaces and line ends, or with an added token, go to the library as they are.
    """

    LETTERS = r"A-Za-zÀ-ÖØ-öø-ÿ"
    PLAIN = re.compile(rf"(\n?)([{LETTERS}]+)")

    def __init__(self, path: str):
        self.library = tokenizer(path)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        spaces = "".join(f"\\x{{{ord(c):x}}}" for c in SPACES)
        self.odd = "|".join([*map(re.escape, added), r"[ \n][ \n]", f"[{HEAD}{MARK}{spaces}]"])
        self.before_marks = rf"([{self.LETTERS}])([.,;:!?])"
        self.plain = self._is_plain()
        self.byte_chars = str.maketrans(_byte_chars())
        self.space = " ".translate(self.byte_chars)
        self.words = pa.array([], pa.string())
        self.flat = np.zeros(0, np.uint32)  # ids of all words
        self.begins = self.lengths = np.zeros(0, np.int64)

    def _is_plain(self) -> bool:
        """Whether pre-tokens are split as by GPT-2's pattern, which the rules for words rely on."""
        import json

        spec = json.loads(self.library.to_str())
        pre = spec.get("pre_tokenizer") or {}
        return (
            spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and pre.get("use_regex") is True and not pre.get("add_prefix_space")
        )

    def _known(self, pre_token: str) -> list[int]:
        chars = pre_token.encode().decode("latin-1").translate(self.byte_chars)
        return [t.id for t in self.library.model.tokenize(chars)]

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _ids(self, word: str) -> list[int]:
        if word.isalpha() and word.isascii():
            return [t.id for t in self.library.model.tokenize(self.space + word)]
        if word[:1] in (HEAD, MARK, "\n"):
            plain = self.PLAIN.fullmatch(word)
            if plain:
                return self._known("\n") + self._known(plain[2])
            return self.whole(word if word[0] == "\n" else word[1:])
        return self._known(" " + word) if self.PLAIN.fullmatch(word) else self.whole(" " + word)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Place of each of some distinct words in the table; new ones are added."""
        found = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(found))
        ids = [self._ids(word) for word in new.to_pylist()]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        number = found.to_numpy(zero_copy_only=False).astype(np.float64)
        number[np.isnan(number)] = len(self.words) + np.arange(len(new))
        begin = len(self.flat) + np.cumsum(size) - size
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, size.sum())])
        self.begins, self.lengths = np.concatenate([self.begins, begin]), np.concatenate([self.lengths, size])
        self.words = pa.concat_arrays([self.words, new])
        return number.astype(np.int64)

    def _spread(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and where each word's end."""
        size = self.lengths[number]
        ends = np.cumsum(size)
        at = np.repeat(self.begins[number] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at], ends

    def _trim(self, used: np.ndarray) -> None:
        """Remember only the words of the last texts."""
        used = np.unique(used)
        flat, ends = self._spread(used)
        self.words, self.lengths = self.words.take(pa.array(used)), self.lengths[used]
        self.flat, self.begins = flat, ends - self.lengths

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text. Arrow splits the texts and numbers their words; only words that are not
        remembered are looked at one by one."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        odd = odd.astype(bool) | (not self.plain)
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        for i in np.flatnonzero(odd):
            out[i] = np.array(self.whole(texts[i].as_py()), "<u4")
        rest = texts.filter(pa.array(~odd))
        if not len(rest):
            return out
        cut = pc.replace_substring_regex(rest, self.before_marks, rf"\1 {MARK}\2")
        parts = pc.split_pattern(pc.replace_substring(cut, "\n", " \n"), " ")
        edges = parts.offsets.to_numpy()
        words = parts.values.slice(edges[0], edges[-1] - edges[0]).dictionary_encode()
        edges = edges - edges[0]
        number = self.numbers(words.dictionary)[words.indices.to_numpy()]
        # A text's first word has no space before it.
        heads = words.take(pa.array(edges[:-1])).dictionary_decode()
        heads = pc.binary_join_element_wise(pa.array([HEAD] * len(heads)), heads, "").dictionary_encode()
        number[edges[:-1]] = self.numbers(heads.dictionary)[heads.indices.to_numpy()]
        ids, ends = self._spread(number)
        bounds = np.concatenate([[0], ends])[edges]
        for i, low, high in zip(np.flatnonzero(~odd), bounds[:-1], bounds[1:], strict=True):
            out[i] = ids[low:high]
        if len(self.words) > MEMO_WORDS:
            self._trim(number)
        return out


def _byte_chars() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Fixed rule of such vocabularies: printable Latin-1 stands for itself, the rest follow from 256.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
