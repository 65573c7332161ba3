"""Operator 4: exact token counts, huge documents by overlapping chunks.

A text longer than a chunk is encoded chunk by chunk, with offsets, each chunk beginning before the
one before it ends. Two encodings are joined at a boundary that both have:

* The left encoding begins at a true boundary, so its pre-token boundaries are true up to its last
  pre-tokens, which the cut may have changed.
* Splitting into pre-tokens goes left to right and looks at nothing before the place where it
  stands. From a true boundary that the right encoding has as well, both go on alike.

So a common pre-token boundary, away from both cuts by more than the longest added token and the
last pre-tokens, proves that the right encoding is the true one from there on. If the overlap has no
such boundary, it is doubled, in the end to the whole rest of the text.
"""

from __future__ import annotations

from collections.abc import Callable
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import for_workers, groups, text_or_empty
from gridspark.llm.word_ids import tokenizer, word_ids

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: Bytes of the texts that are encoded together.
GROUP_BYTES = 4 << 20


def margin(loaded) -> int:
    added = [len(t.content) for t in loaded.get_added_tokens_decoder().values()]
    return 1 + max(added, default=0)


def starts(encoded) -> dict[int, int]:
    """Character at which each pre-token begins -> index of its first token."""
    found: dict[int, int] = {}
    last = object()
    for index, (word, (begin, _)) in enumerate(zip(encoded.word_ids, encoded.offsets, strict=True)):
        if word != last or word is None:
            found.setdefault(begin, index)
        last = word
    return found


def spliced(text: str, loaded, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Number of tokens of `text` from overlapping chunks."""
    if not 0 < overlap < chunk:
        raise ValueError("the overlap is positive and shorter than a chunk")
    guard = margin(loaded)
    total, begin, end = 0, 0, min(len(text), chunk)
    left = loaded.encode(text[begin:end], add_special_tokens=False)
    while end < len(text):
        wide = overlap
        while True:
            # The right chunk begins `wide` characters before the left one ends.
            if wide >= end - begin:  # nothing of the left chunk is left: encode both as one
                end = min(len(text), end + max(chunk, end - begin))
                left = loaded.encode(text[begin:end], add_special_tokens=False)
                break
            at = end - wide
            upto = min(len(text), at + max(chunk, 2 * wide))
            right = loaded.encode(text[at:upto], add_special_tokens=False)
            ours, theirs = starts(left), starts(right)
            # The last two pre-tokens before the cut can still change, as can an added token.
            stable = sorted(ours)[:-2]
            common = [
                p for p in reversed(stable)
                if begin + p - at >= guard and end - (begin + p) >= guard and begin + p - at in theirs
            ]
            if common:
                place = begin + common[0]
                total += ours[common[0]]
                skip = theirs[place - at]
                begin, end = place, upto
                left = _Rest(right, skip, place - at)
                break
            wide *= 2
    return total + len(left.ids)


class _Rest:
    """An encoding from a token on, with offsets counted from there."""

    def __init__(self, encoded, skip: int, shift: int):
        self.ids = encoded.ids[skip:]
        self.word_ids = encoded.word_ids[skip:]
        self.offsets = [(a - shift, b - shift) for a, b in encoded.offsets[skip:]]


def counter(path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> Callable[[pa.Array], list[int]]:
    """Token counts of an array of texts, by the library that the file is for."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts.to_pylist(), num_threads=1)]
    loaded, words = tokenizer(path), word_ids(path)

    def counts(texts: pa.Array) -> list[int]:
        short = pc.less_equal(pc.utf8_length(texts), chunk)
        each = iter(words.encode(texts.filter(short)))
        return [
            len(next(each)) if is_short else spliced(text.as_py(), loaded, chunk, overlap)
            for text, is_short in zip(texts, short.to_pylist(), strict=True)
        ]

    return counts


def count_tokens(
    df: DataFrame,
    path: str,
    key: str,
    text: str = "text",
    limit: int = 512,
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
) -> DataFrame:
    """One row per row of `df`: `key`, `n_bytes` (UTF-8), `n_tokens`, `over_limit`.

    Null texts count as empty: 0, 0, false. `.json` files go to the tokenizers library, `.model`
    files to sentencepiece, which takes every text whole. Repeated rows stay; other columns of `df`
    are not read.
    """
    for_workers(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(frames):
        counts = counter(path, chunk, overlap)
        for frame in frames:
            for part in groups(frame, GROUP_BYTES):
                found = pa.array(counts(part.column(2)), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), found], names=[key, "n_bytes", "n_tokens"]
                )

    whole = text_or_empty(text)
    picked = df.select(F.col(key), F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias("text"))
    counted = picked.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


