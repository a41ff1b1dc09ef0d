"""A caller's tokenizer in place of the built-in split.

Only the calls into the tokenizer run in Python, as Arrow-batched UDFs that
build it once per task. Its counts need not add up over messages, so what fits
is decided on whole candidate texts, one after the other as far as needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .joined_counts import JoinedCounts
from .message import think_text

# Text to (ids, [(start, end), ...]) with character offsets.
Encode = Callable[[str], tuple[list[int], list[tuple[int, int]]]]

MARKED_IDS = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("in_loss", T.ArrayType(T.BooleanType())),
    ]
)

CHOICE = T.StructType(
    [
        T.StructField("dropped", T.IntegerType()),
        T.StructField("cuts", T.ArrayType(T.IntegerType())),
    ]
)


@dataclass(frozen=True)
class ExternalTokenizer:
    """``make`` (and ``make_decode``) run on the workers and must be picklable.

    ``atomic_markers`` states that no token reaches across a template marker or think tag
    and that each is a token of its own, as in chat tokenizers. Then counts of messages add
    up, each message is encoded once, and what fits follows from sums.

    ``agreement`` is for the others: encodings that have given the same tokens over that many
    characters of the same text go on alike, and the end of a text changes no more than that
    (see :class:`JoinedCounts`). Then choices are counted from encoded parts, with only the text
    around their joints encoded anew. The choice found and the one before it are encoded whole;
    if the counts do not bear it out, or neither statement is made, every choice is encoded whole.
    """

    make: Callable[[], Encode]
    eos_id: int | None = None
    make_decode: Callable[[], Callable[[list[int]], str]] | None = None
    atomic_markers: bool = False
    agreement: int | None = None

    def count(self, text: Column) -> Column:
        """Number of tokens of a text."""
        make = self.make

        @F.pandas_udf(T.IntegerType())
        def count_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode = make()
            for texts in batches:
                counts = [None if t is None else len(encode(t)[0]) for t in texts]
                yield pd.Series(counts, dtype="Int32")

        return count_tokens(text)

    def cap(self, texts: Column, n: int) -> Column:
        """The first ``n`` tokens of each text of an array; shorter texts as they are."""
        if self.make_decode is None:
            raise ValueError("think_max_tokens needs a tokenizer that can decode")
        make, make_decode = self.make, self.make_decode

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def cap_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode, decode = make(), make_decode()

            def capped(text: str | None) -> str | None:
                ids = [] if text is None else encode(text)[0]
                return text if len(ids) <= n else decode(ids[:n])

            for rows in batches:
                yield pd.Series([[capped(t) for t in row] for row in rows])

        return cap_texts(texts)

    def choose(
        self,
        head: Column,
        leading: Column,
        following: Column,
        blocks: Column,
        rest: Column,
        limit: int,
    ) -> Column:
        """``dropped`` middle messages and ``cuts`` of tail reasoning: the first choice that fits.

        Choices start at a middle message, from old to new: the head, that
        message in its ``leading`` form (it may carry the tool schemas), the
        ``following`` ones, the tail. Then the middle is gone and the reasoning
        of the tail's ``blocks`` (before or alone, reasoning, after) is halved in
        turn; reasoning that never fits is emptied. The last choice needs no fit.
        NULL in, NULL out.
        """
        make, additive, agreement = self.make, self.atomic_markers, self.agreement
        opens, closes = think_text("|").split("|")

        def choices(n_middle: int, blocks: list) -> Iterator[tuple[int, list[int | None]]]:
            cuts: list[int | None] = [None] * len(blocks)
            for start in range(1, n_middle):
                yield start, cuts
            for i, block in enumerate(blocks):
                size = len(block["reasoning"] or "")
                for halvings in range(size.bit_length()):
                    yield n_middle, [*cuts[:i], size >> halvings, *cuts[i + 1 :]]
                if size:
                    cuts = [*cuts[:i], 0, *cuts[i + 1 :]]
            yield n_middle, cuts

        def block_text(block: dict, cut: int | None, start: str) -> str:
            thought = (block["reasoning"] or "")[:cut]
            shown = opens + thought + closes if thought else ""
            return block[start] + shown + block["after"]

        @F.pandas_udf(CHOICE)
        def choose_first(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            encode = make()

            def size(text: str) -> int:
                return len(encode(text)[0])

            def summed(head, leading, following, blocks, rest) -> dict:
                """The same choice from counts of messages, each encoded once."""
                n = len(leading)
                fixed = size(head) + size(rest)
                after = [0] * (n + 1)
                for i in range(n - 1, -1, -1):
                    after[i] = after[i + 1] + size(following[i])
                whole = [size(block_text(b, None, "before")) for b in blocks]
                for start in range(1, n):
                    if fixed + sum(whole) + after[start + 1] + size(leading[start]) <= limit:
                        return {"dropped": start, "cuts": [None] * len(blocks)}
                sizes = [size(block_text(b, None, "alone")) for b in blocks]
                cuts: list[int | None] = [None] * len(blocks)
                for i, block in enumerate(blocks):
                    length = len(block["reasoning"] or "")
                    for halvings in range(length.bit_length()):
                        cut = length >> halvings
                        n_cut = size(block_text(block, cut, "alone"))
                        if fixed + sum(sizes) - sizes[i] + n_cut <= limit:
                            return {"dropped": n, "cuts": [*cuts[:i], cut, *cuts[i + 1 :]]}
                    if length:
                        cuts[i], sizes[i] = 0, size(block_text(block, 0, "alone"))
                return {"dropped": n, "cuts": cuts}

            def joined(head, leading, following, blocks, rest) -> dict:
                """The same choice from encoded parts; see :class:`JoinedCounts`."""
                counts = JoinedCounts(encode, agreement)
                n = len(leading)
                if n > 1:
                    tail = "".join(block_text(b, None, "before") for b in blocks) + rest
                    left, right, at = counts.known(head), counts.known("".join(following[2:]) + tail), 0
                    for start in range(1, n):
                        if counts.count(left, leading[start], right, at) <= limit:
                            return {"dropped": start, "cuts": [None] * len(blocks)}
                        at += len("".join(following[start + 1 : start + 2]))
                cuts: list[int | None] = [None] * len(blocks)
                for i, block in enumerate(blocks):
                    length = len(block["reasoning"] or "")
                    shown = [block_text(b, c, "alone") for b, c in zip(blocks, cuts)]
                    if length:
                        left = counts.known(head + "".join(shown[:i]))
                        right = counts.known("".join(shown[i + 1 :]) + rest)
                    for halvings in range(length.bit_length()):
                        cut = length >> halvings
                        if counts.count(left, block_text(block, cut, "alone"), right) <= limit:
                            return {"dropped": n, "cuts": [*cuts[:i], cut, *cuts[i + 1 :]]}
                    if length:
                        cuts[i] = 0
                return {"dropped": n, "cuts": cuts}

            def fits(choice, head, leading, following, blocks, rest) -> bool:
                start, cuts = choice
                middle = "".join([*leading[start : start + 1], *following[start + 1 :]])
                way = "before" if middle else "alone"
                tail = "".join(block_text(b, c, way) for b, c in zip(blocks, cuts)) + rest
                return size(head + middle + tail) <= limit

            def borne_out(found: dict, *row) -> bool:
                """Whether the choice fits, unless it is the last one, and the one before does not."""
                before = None
                listed = choices(len(row[1]), row[3])
                for choice in listed:
                    if choice == (found["dropped"], found["cuts"]):
                        last = next(listed, None) is None
                        return (last or fits(choice, *row)) and (before is None or not fits(before, *row))
                    before = choice
                return False

            def chosen(*row) -> dict:
                if row[0] is None:
                    return {"dropped": None, "cuts": None}
                if additive:
                    return summed(*row)
                if agreement is not None:
                    found = joined(*row)
                    if borne_out(found, *row):
                        return found
                for start, cuts in choices(len(row[1]), row[3]):
                    if fits((start, cuts), *row):
                        break
                return {"dropped": start, "cuts": cuts}

            for rows in batches:
                yield pd.DataFrame(
                    [chosen(*row) for row in zip(*rows)], columns=["dropped", "cuts"]
                ).astype({"dropped": "Int32"})

        return choose_first(head, leading, following, blocks, rest)

    def marked_ids(self, texts: Column, in_loss: Column) -> Column:
        """Ids of the joined segments; a token is in loss if any of its characters is."""
        make = self.make

        @F.pandas_udf(MARKED_IDS)
        def encode_segments(
            batches: Iterator[tuple[pd.Series, pd.Series]],
        ) -> Iterator[pd.DataFrame]:
            encode = make()

            def marks(texts: list[str], flags: list[bool], offsets: list[tuple[int, int]]):
                per_char = np.repeat(np.asarray(flags, dtype=bool), [len(t) for t in texts])
                upto = np.concatenate([[0], np.cumsum(per_char)])
                spans = np.asarray(offsets, dtype=np.int64).reshape(-1, 2)
                return upto[spans[:, 1]] > upto[spans[:, 0]]

            for text_rows, flag_rows in batches:
                ids, loss = [], []
                for texts, flags in zip(text_rows, flag_rows):
                    row_ids, offsets = encode("".join(texts))
                    ids.append(row_ids)
                    loss.append(marks(texts, flags, offsets))
                yield pd.DataFrame({"ids": ids, "in_loss": loss})

        # Keeps later filters above the UDF; pushed below, they would run it twice.
        return encode_segments.asNondeterministic()(texts, in_loss)
