"""Token counts per section by offset-mapped attribution.

A document is encoded once, as a whole; every token then has a span of characters. The spans are
interval-joined with the document's sections, so that no section is encoded out of its context and
the counts of all sections add up to the document's.

Sections are the lines of a document, its sentences, or spans that a column gives. Most tokenizers put the blank
before a word into the word's token, while a sentence keeps the blank behind it: nearly every sentence starts
within a token, and the rule below decides whose it is.

Allocation rule: a token that lies in several sections counts for the one that holds most of its
characters, for the earliest of these on a tie. `n_crossing` says how many of a section's tokens reach
beyond it. Tokens in no section are counted as `unattributed` on the document's rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType


# A sentence ends behind its marks, closing quotes or brackets and the white space after them, or with a line.
SENTENCE_END = regex.compile(r"""[.!?…。！？]["'”’)\]]*\p{White_Space}+|\n\p{White_Space}*""")
LONG_RUN = regex.compile(r"\p{White_Space}{1000,}")


class SpanEncoder:
    """Character spans of a text's tokens under a byte-level BPE given as ranks."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def ids(self, text: str) -> np.ndarray:
        """The tokens of a text.

        The pattern's alternatives for white space try one character less until they fit, which fails on long
        runs. Such a run is one piece up to its last character, which goes with what follows, or up to the end
        of the text; so it is taken out and encoded as the piece it is.
        """
        pieces, at = [], 0
        for run in LONG_RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            if run.start() > at:
                pieces.append(self.encoding.encode_to_numpy(text[at : run.start()], disallowed_special=()))
            pieces.append(self._piece(text[run.start() : end]))
            at = end
        if at < len(text) or not pieces:
            pieces.append(self.encoding.encode_to_numpy(text[at:], disallowed_special=()))
        return np.concatenate(pieces)

    def _piece(self, text: str) -> np.ndarray:
        return np.array(self.encoding._core_bpe.encode_single_piece(text.encode()), np.uint32)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end character of each token; part of a character counts as the whole."""
        ids = self.ids(text)
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        raw = text.encode()
        if len(raw) > len(text):
            opens = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
            char = np.cumsum(opens) - 1  # the character that each byte belongs to
            return char[starts], char[ends - 1] + 1
        return starts, ends


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end character of each line, its line break included."""
    lengths = np.array([len(x) + 1 for x in text.split("\n")], np.int64)
    lengths[-1] -= 1
    ends = np.cumsum(lengths)
    return ends - lengths, ends


def sentence_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end character of each sentence, the white space behind it included; one empty one for no text."""
    ends = [m.end() for m in SENTENCE_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return np.array([0, *ends[:-1]], np.int64), np.array(ends, np.int64)


SECTIONS = {"line": line_sections, "sentence": sentence_sections}


def attribute(
    starts: np.ndarray, ends: np.ndarray, lefts: np.ndarray, rights: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens and crossing tokens per section, and tokens in no section.

    Sections are half-open, in order and without overlap; gaps between them are allowed.
    """
    full = np.flatnonzero(rights > lefts)
    counts, crossing = np.zeros(len(lefts), np.int64), np.zeros(len(lefts), np.int64)
    if not len(full) or not len(starts):
        return counts, crossing, len(starts)
    left, right = lefts[full], rights[full]
    first = np.searchsorted(right, starts, "right")
    last = np.searchsorted(left, ends, "left") - 1
    counts[full] += np.bincount(first[first == last], minlength=len(full))
    # A token over two sections: the later one only if it holds more, as the earlier wins a tie.
    two = np.flatnonzero(last - first == 1)
    a, b = first[two], last[two]
    early = np.minimum(right[a], ends[two]) - np.maximum(left[a], starts[two])
    late = np.minimum(right[b], ends[two]) - np.maximum(left[b], starts[two])
    chosen = full[np.where(late > early, b, a)]
    np.add.at(counts, chosen, 1)
    np.add.at(crossing, chosen, 1)
    for t in np.flatnonzero(last - first > 1):
        among = np.arange(first[t], last[t] + 1)
        held = np.minimum(right[among], ends[t]) - np.maximum(left[among], starts[t])
        chosen = full[among[np.argmax(held)]]
        counts[chosen] += 1
        crossing[chosen] += 1
    edge = np.flatnonzero(first == last)
    out = edge[(starts[edge] < left[first[edge]]) | (ends[edge] > right[first[edge]])]
    crossing[full] += np.bincount(first[out], minlength=len(full))
    return counts, crossing, int(np.sum(first > last))


def section_tokens(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    sections_col: str | None = None,
    kinds: tuple[str, ...] = ("line",),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per section: doc_id, kind, section (from 0), start, end, n_tokens, n_crossing, doc_tokens, unattributed.

    `sections_col` holds an array of structs (start, end) in characters, in order and without overlap, and
    the kind is "given"; without it the sections are those of `kinds`, each kind covering the whole document, which
    is encoded once for all. A null text is an empty one; a document without sections
    has one empty section, so every row of `docs` is in the result. Repeated rows and doc_ids are
    counted row by row; other columns are ignored; an empty table gives no rows.
    """
    names = ["section", "start", "end", "n_tokens", "n_crossing", "doc_tokens", "unattributed"]
    schema = StructType(
        [StructField("doc_id", docs.schema[id_col].dataType), StructField("kind", StringType())]
        + [StructField(n, LongType()) for n in names]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = SpanEncoder(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                piece = batch.slice(at, 512)
                given = piece.column(2).to_pylist() if sections_col else [None] * piece.num_rows
                rows, labels, columns = [], [], [[] for _ in names]
                for row, (text, spans) in enumerate(zip(piece.column(1).to_pylist(), given)):
                    text = text or ""
                    if sections_col:
                        spans = np.array(
                            [(s["start"], s["end"]) for s in spans or []] or [(0, 0)], np.int64
                        )
                        cuts = {"given": (spans[:, 0], spans[:, 1])}
                    else:
                        cuts = {kind: SECTIONS[kind](text) for kind in kinds}
                    starts, ends = encoder.spans(text)
                    for kind, (lefts, rights) in cuts.items():
                        counts, crossing, rest = attribute(starts, ends, lefts, rights)
                        n = len(lefts)
                        rows.append(np.full(n, row))
                        labels += [kind] * n
                        for column, values in zip(
                            columns,
                            (np.arange(n), lefts, rights, counts, crossing,
                             np.full(n, len(starts)), np.full(n, rest)),
                        ):
                            column.append(values)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(pa.array(np.concatenate(rows))), pa.array(labels, pa.string())]
                    + [pa.array(np.concatenate(c).astype(np.int64)) for c in columns],
                    names=schema.names,
                )

    wanted = [id_col, text_col] + ([sections_col] if sections_col else [])
    return docs.select(*wanted).mapInArrow(count, schema)
