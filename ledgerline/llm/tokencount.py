"""Token counts of a byte-fallback piece tokenizer by a deterministic transducer.

Pair merging has a property that makes it a left-to-right machine: in the encoding of every
prefix of a text the last piece is the one suffix of the prefix that is a piece and that
merging would not have split differently against the piece before it. What the next
character can change lies within the longest suffix that some piece starts with. A state
therefore is that suffix with the last piece and the relative count at each place in it;
states and transitions are compiled when first met. A transition carries the change of the
number of pieces.

A chunk of text maps every state it can be entered in to a state and a count. Where a word begins
or a line ends the machine is in one known state whatever it came from, so a chunk with such a
boundary ends alike for all its entries, and its words are counted once. Chunk maps compose
associatively; a prefix scan over the maps of a text gives the state and the count before every
chunk. Long texts are cut at boundaries into stretches that are counted in different tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow, in_slices, table, texts, written
from ledgerline.llm.tokenfile import tokenizer_path

TOKENIZER = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK = 1 << 16
# Characters beyond which a text is counted in stretches of that size, spread over tasks.
STRETCH = 1 << 21
# Transducer states and segments a Python worker keeps before it starts anew.
KEPT_STATES, KEPT_SEGMENTS = 300_000, 700_000

SPACE = "▁"
_HEAD = re.compile(" *[^ \n]*")
_SEGMENT = re.compile(" +[^ \n]*|\n[^ \n]*")
_BOUNDARY = re.compile("(?<! ) |\n")

# The state as it is known outside a machine: the suffix, and per place in it the last piece and the count.
State = tuple[str, tuple[tuple[str, int], ...]]
START: State = ("", (("", 0),))
# What a chunk does: per entry state, the state it ends in and its count.
ChunkMap = dict[State, tuple[State, int]]


class Transducer:
    """States are numbers; ``step`` gives the next state and how the piece count changes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        skipped = [model.is_control, model.is_unknown, model.is_byte, model.is_unused]
        self.rank = {
            model.id_to_piece(i): (-model.get_score(i), i)
            for i in range(model.get_piece_size()) if not any(f(i) for f in skipped)
        }
        probe = "ﬁ  Ａ é　x­"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models that leave texts as they are, with a space in front, are understood")
        if any(SPACE in p.lstrip(SPACE) for p in self.rank) or any("\n" in p for p in self.rank):
            raise ValueError("only models whose pieces hold spaces in front and no line ends are understood")
        if any(c not in self.rank for p in self.rank for c in p):
            raise ValueError("only models whose pieces consist of characters that are pieces are understood")
        self.heads = {p[:k] for p in self.rank for k in range(1, len(p))}
        self.agrees: dict[tuple[str, str], bool] = {}
        self.counts: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[State, int] = {START: 0}
        self.states: list[State] = [START]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.counts.clear()

    def _merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging: always the best-ranked pair, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            found = [(self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.rank]
            if not found:
                break
            at = min(found)[1]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _agree(self, before: str, piece: str) -> bool:
        """Whether the two stay side by side when their text is merged."""
        key = (before, piece)
        found = self.agrees.get(key)
        if found is None:
            if len(self.agrees) > KEPT_STATES:
                self.agrees.clear()
            wanted = [before, piece] if before else [piece]
            found = self.agrees[key] = self._merged(before + piece) == wanted
        return found

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        if char not in self.rank:
            return 0, len(char.encode("utf-8", "replace"))  # spelled as bytes; nothing merges across it
        suffix, context = self.states[state]
        if char == SPACE and suffix[-1:] != SPACE:
            suffix, context = "", (("", 0),)  # a word begins: no piece reaches back
        text = suffix + char
        start = next(k for k in range(len(text)) if text[k:] in self.rank and self._agree(context[k][0], text[k:]))
        count = context[start][1] + 1
        places = (*context, (text[start:], count))
        keep = next((k for k in range(len(text)) if text[k:] in self.heads), len(text))
        key = (text[keep:], tuple((piece, n - count) for piece, n in places[keep:]))
        return self._number(key), count

    def _number(self, state: State) -> int:
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
        return number

    def follow(self, text: str, state: State) -> tuple[State, int]:
        """The same from a state known by its content to one; states may be forgotten between calls."""
        if len(self.states) > KEPT_STATES:
            self._forget()
        end, count = self.run(text, self._number(state))
        return self.states[end], count

    def run(self, text: str, state: int = 0) -> tuple[int, int]:
        """End state and change of the piece count over a text written with SPACE for spaces."""
        moves, total = self.moves, 0
        for char in text:
            move = moves[state].get(char)
            if move is None:
                move = moves[state][char] = self._compile(state, char)
            state, change = move
            total += change
        return state, total

    def segment(self, key: str) -> int:
        """Pieces of a segment: a word with the space before it left out, or a line end and a word."""
        found = self.counts.get(key)
        if found is None:
            if len(self.states) > KEPT_STATES:
                self._forget()
            elif len(self.counts) > KEPT_SEGMENTS:
                self.counts.clear()
            shown = key.replace(" ", SPACE)
            found = self.counts[key] = self.run(shown if key[:1] == "\n" else SPACE + shown)[1]
        return found


def _shown(text: str) -> str:
    return text.replace(" ", SPACE)


def chunk_map(machine: Transducer, text: str, entries: Iterable[State]) -> ChunkMap:
    """Map of a chunk of text (spaces as spaces) for the states it can be entered in.

    The text up to the first boundary is run from every entry. What follows is the same for all:
    whole segments by their counts, which are kept, and the last one up to the state it ends in.
    """
    head = _HEAD.match(text).group()
    body = text[len(head):]
    starts = {entry: machine.follow(_shown(head), entry) for entry in entries}
    if not body:
        return starts
    if "  " not in body and " \n" not in body:  # single spaces: the words as they are
        keys = body.replace("\n", " \n").split(" ")[1:]
    else:
        keys = [s[1:] if s[0] == " " else s for s in _SEGMENT.findall(body)]
    tail = keys.pop()
    counts = list(map(machine.counts.get, keys))
    if None in counts:
        counts = [machine.segment(k) if n is None else n for k, n in zip(keys, counts)]
    end, last = machine.follow(_shown(tail if tail[:1] == "\n" else " " + tail), START)
    inner = sum(counts) + last
    return {entry: (end, count + inner) for entry, (_, count) in starts.items()}


def compose(left: ChunkMap, right: ChunkMap) -> ChunkMap:
    """The map of both chunks one after the other. Associative."""
    return {entry: (right[state][0], count + right[state][1]) for entry, (state, count) in left.items()}


def scan(maps: Sequence[ChunkMap]) -> list[ChunkMap]:
    """Maps of all prefixes, by doubling: after k rounds every place holds the map of 2^k chunks up to it.

    The steps of a round do not depend on each other, and their number is the logarithm of the chunks.
    """
    now, reach = list(maps), 1
    while reach < len(now):
        now = [compose(now[i - reach], now[i]) if i >= reach else now[i] for i in range(len(now))]
        reach *= 2
    return now


def chunk_maps(machine: Transducer, text: str, chunk: int = CHUNK) -> list[ChunkMap]:
    """Maps of the chunks of a text (spaces as spaces), each for the states the one before can end in."""
    maps: list[ChunkMap] = []
    entries: set[State] = {START}
    for at in range(0, len(text), chunk):
        maps.append(chunk_map(machine, text[at:at + chunk], entries))
        entries = {end for end, _ in maps[-1].values()}
    return maps


def count_from_boundary(machine: Transducer, text: str, chunk: int = CHUNK) -> int:
    """Tokens of a stretch of text (spaces as spaces) that starts at a boundary."""
    return scan(chunk_maps(machine, text, chunk))[-1][START][1] if text else 0


def prepared(text: str) -> str:
    """The text as the tokenizer sees it, with spaces as spaces: it puts a space in front."""
    return " " + text.replace(SPACE, " ") if text else ""


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """A prepared text cut at boundaries into parts of at least ``size`` characters, but for the last."""
    at = 0
    while at < len(text):
        cut = _BOUNDARY.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def count_tokens(machine: Transducer, text: str, chunk: int = CHUNK) -> int:
    """Tokens of a whole text; an empty text has none."""
    return count_from_boundary(machine, prepared(text), chunk)


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per Python worker, kept from task to task."""
    return Transducer(path)


def token_counts(documents: DataFrame, model: str, limit: int = LIMIT, stretch: int = STRETCH) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit`` tokens) of every row.

    NULL and empty texts have 0 of both. Texts of any length are counted whole: one longer than
    ``stretch`` characters is cut at boundaries, its stretches are spread over tasks, and their
    counts summed; nothing else is shuffled. Repeated rows are counted each, a missing doc_id
    stays NULL, extra columns are not read. An empty table gives no rows.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, row string, part string"
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, task, long = transducer(model), TaskContext.get().partitionId(), 0
        for batch in in_slices(batches):
            rows: list[tuple] = []
            for key, text in zip(batch.column("doc_id").to_pylist(), texts(batch)):
                size = len(text.encode())
                if len(text) <= stretch:
                    rows.append((key, size, count_tokens(machine, text), None, None))
                    continue
                long += 1
                for number, part in enumerate(stretches(prepared(text), stretch)):
                    rows.append((key, 0 if number else size, None, f"{task}-{long}", part))
            yield arrow(schema, dict(zip(names, zip(*rows))) if rows else {name: [] for name in names})

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model)
        for batch in in_slices(batches, "part"):
            counts = [count_from_boundary(machine, part) for part in texts(batch, "part")]
            yield arrow("row string, doc_id long, n_bytes long, n_tokens long", {
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": counts,
            })

    plain = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = written(plain.mapInArrow(run, schema), "counted")
    parts = counted.filter("row is not null").select("row", "doc_id", "n_bytes", "part").repartition("row", "part")
    summed = parts.mapInArrow(finish, "row string, doc_id long, n_bytes long, n_tokens long").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens")
    )
    columns = ["doc_id", "n_bytes", "n_tokens"]
    return counted.filter("row is null").select(*columns).unionByName(summed.select(*columns)).withColumn("over_limit", F.col("n_tokens") > limit)


def op4_tokencount(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return token_counts(table(spark, folder, "documents"), tokenizer_path(TOKENIZER))
