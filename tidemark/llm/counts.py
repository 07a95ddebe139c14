"""Token counts per section from one encoding of the whole document.

A document is encoded once. The byte lengths of its tokens, summed up, give every token's span in the
UTF-8 text (byte-level BPE loses no byte), and the spans are interval-joined to the sections, which
are cut after every ``\\n``. A token inside one section counts there. **A token that crosses a
boundary counts, whole, for the section that holds most of its bytes; on a tie for the earliest of
them.** The counts of a document's sections therefore add up to its token count.

Defined results: a NULL or empty text has one section, 0, of no characters and no tokens; a text that
ends in ``\\n`` has no empty section after it. Every input row yields its own rows, so repeated rows
repeat; a NULL id stays NULL. Other columns are not read.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import arrow_column, remember_as

VOCABULARY = "byte_bpe_50k.tiktoken"
SECTIONS = "array<struct<section:int,start_char:long,end_char:long,n_tokens:long,n_crossing:long>>"


@lru_cache(maxsize=2)
def encoder(vocabulary: str):
    """The encoding and the byte length of each of its ids."""
    import public_tokenizers
    import tiktoken

    remember_as(__name__, encoder.cache_clear)

    with open(public_tokenizers.path(vocabulary), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    encoding = tiktoken.Encoding(
        vocabulary,
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={},
    )
    return encoding, lengths


def allocate(ends: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and crossing tokens of each section.

    ``ends`` are the byte ends of the tokens, ``cuts`` the byte bounds of the sections, both
    starting at 0 and ending at the same place.
    """
    sections = len(cuts) - 1
    starts = np.concatenate(([0], ends[:-1]))
    first = np.searchsorted(cuts, starts, "right") - 1
    last = np.searchsorted(cuts, ends, "left") - 1
    crossing = np.flatnonzero(first != last)
    for i in crossing:
        inner = cuts[first[i] : last[i] + 2].clip(starts[i], ends[i])
        first[i] += int(np.argmax(np.diff(inner)))
    return (
        np.bincount(first, minlength=sections),
        np.bincount(first[crossing], minlength=sections),
    )


def count_batch(vocabulary: str, texts: list[str | None]) -> pa.Array:
    encoding, lengths = encoder(vocabulary)
    offsets, numbers, begins, finishes, tokens, crossed = [0], [], [], [], [], []
    for text in texts:
        if not text:
            numbers.append(np.zeros(1, np.int32))
            for column in (begins, finishes, tokens, crossed):
                column.append(np.zeros(1, np.int64))
            offsets.append(offsets[-1] + 1)
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        after = np.flatnonzero(raw == 10) + 1
        if not len(after) or after[-1] != len(raw):
            after = np.append(after, len(raw))
        cuts = np.concatenate(([0], after))
        # A byte that is no continuation byte starts a character.
        chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))[cuts]
        ids = encoding.encode_to_numpy(text)
        counted, crossing = allocate(np.cumsum(lengths[ids]), cuts)
        numbers.append(np.arange(len(after), dtype=np.int32))
        begins.append(chars[:-1])
        finishes.append(chars[1:])
        tokens.append(counted)
        crossed.append(crossing)
        offsets.append(offsets[-1] + len(after))
    whole = lambda parts, kind: pa.array(
        np.concatenate(parts) if parts else np.zeros(0), kind
    )
    rows = pa.StructArray.from_arrays(
        [whole(numbers, pa.int32())] + [whole(x, pa.int64()) for x in (begins, finishes, tokens, crossed)],
        ["section", "start_char", "end_char", "n_tokens", "n_crossing"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)


def section_counts(text: str | Column, vocabulary: str = VOCABULARY) -> Column:
    """The sections of a text with their character spans and token counts."""
    return arrow_column(lambda texts: count_batch(vocabulary, texts), SECTIONS, text)


def count_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per document and section: id, section, start_char, end_char, n_tokens, n_crossing."""
    return docs.select(
        F.col(id_col).alias("doc_id"), section_counts(F.col(text_col), vocabulary).alias("_found")
    ).select("doc_id", F.inline("_found"))
