"""The row elements of XML files, one file read by many tasks.

A file is read as text cut at ``</row``, so a split begins there: in text, or inside a comment, a CDATA section, a processing instruction,
a DOCTYPE's subset or (in a broken file) a quoted attribute of a row tag. Which one depends on everything before it, so:

1. every split is lexed once from each state it may begin in: the state it ends in, and the row tags left over (closing tags without an
   opening one, opening tags without a closing one). That is a row per split;
2. per file those rows are composed in order: each split's real state, and which row each leftover tag belongs to;
3. every task lexes its splits from their real state and returns the row elements that lie inside one split;
4. elements that cross a border are put together from their pieces, read from the splits that hold some.

Rows may be nested: an opening tag is closed by the next closing tag that isn't taken, each row element is a record, and a record holds its own
text without the rows inside it (so no text is copied, whatever the depth). ``</row >``, row tags in comments and CDATA, and ``>`` in
quoted attributes read as XML has them. An opening tag that is never closed and a closing tag without an opening one are faults.

What reaches the driver and the tasks: the splits that begin inside a row or not in text, and the rows that cross their
borders (a few numbers a split, 128 MB of data each).
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedwright.session import in_session, ship_package, with_fixed_splits

#: What a split may begin in.
TEXT, COMMENT, CDATA, INSTRUCTION, SUBSET, DOUBLE, SINGLE = range(7)

#: How the states but TEXT end.
_END = {COMMENT: "-->", CDATA: "]]>", INSTRUCTION: "?>", SUBSET: "]"}

_OPENS = {"<!--": COMMENT, "<![CDATA[": CDATA, "<?": INSTRUCTION}


class RowLexer:
    """Finds row tags in text that is fed in parts, each beginning at a ``</row`` (the first one anywhere)."""

    def __init__(self, row_tag: str):
        self.name, self.cut, tag = row_tag, f"</{row_tag}", re.escape(row_tag)
        self.token = re.compile(rf"<!--|<!\[CDATA\[|<\?|<!DOCTYPE[^\[>]*\[?|</{tag}\s*>|<{tag}(?=[\s/>])")
        # the rest of an opening tag: up to its end, or up to a quote that isn't closed here
        self.rest = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:(>)|([\"'])|$)")

    def tags(self, text: str, state: int, at: int = 0):
        """Row tags of ``text`` as ``(+1 open, -1 close, 0 empty element, from, to)``, then ``(None, state at the end)``."""
        n = len(text)
        began = None                  # where the current opening tag began (-1: in an earlier part)
        while True:
            if state in _END:
                end = text.find(_END[state], at)
                if end < 0:
                    break
                at, state = end + len(_END[state]), TEXT
            elif state in (DOUBLE, SINGLE):
                end = text.find('"' if state == DOUBLE else "'", at)
                if end < 0:
                    break
                m = self.rest.match(text, end + 1)
                if m[2]:
                    at, state = m.end(), DOUBLE if m[2] == '"' else SINGLE
                    continue
                state, at = TEXT, m.end()
                yield (0 if text[m.end() - 2] == "/" else 1), (-1 if began is None else began), at
                began = None
            else:
                m = self.token.search(text, at)
                if m is None:
                    break
                found = m.group()
                at = m.end()
                if found in _OPENS:
                    state = _OPENS[found]
                elif found[:2] == "<!":
                    state = SUBSET if found[-1] == "[" else TEXT
                elif found[1] == "/":
                    yield -1, m.start(), at
                else:
                    rest = self.rest.match(text, at)
                    at = rest.end()
                    if rest[2]:
                        began, state = m.start(), DOUBLE if rest[2] == '"' else SINGLE
                        continue
                    yield (0 if text[at - 2] == "/" else 1), m.start(), at
        if began is not None:
            # the tag goes on in the next part; it is a row from here
            yield None, began, n
        yield None, state, None


def _compose(a: tuple[int, int], b: tuple[int, int]) -> tuple[int, int]:
    """Leftover (closing, opening) tags of two stretches one after the other."""
    return (a[0] + max(0, b[0] - a[1]), max(0, a[1] - b[0]) + b[1])


def _leftover(lexer: RowLexer, text: str, state: int) -> tuple[int, tuple[int, int]]:
    """The end state and the leftover tags of one part. A row tag that goes on in the next part counts there."""
    closed = opened = 0
    end = state
    for kind, a, b in lexer.tags(text, state):
        if kind is None:
            end = a if b is None else end
        elif kind > 0:
            opened += 1
        elif kind < 0:
            if opened:
                opened -= 1
            else:
                closed += 1
    return end, (closed, opened)


_SUMMARY = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("start", pa.int32()), ("finish", pa.int32()), ("closed", pa.int64()), ("opened", pa.int64())])
_SUMMARY_DDL = "file long, block long, start int, finish int, closed long, opened long"


def _parts(batches):
    """``(file, block, first, chunks)``: the chunks of each batch that are of one split; first: the file's first text is among them."""
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(i).to_numpy() for i in (1, 2))
        starts = np.flatnonzero(np.concatenate([[True], (file[1:] != file[:-1]) | (block[1:] != block[:-1])]))
        values = batch.column(0)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(file)], strict=True):
            here = int(file[a]), int(block[a])
            yield *here, here != at and not here[1], values[a:b]
            at = here


def _text(chunks: pa.Array, first: bool, cut: str) -> str:
    """The chunks as text, with the cuts back (there is none before a file's first chunk)."""
    return ("" if first else cut) + cut.join(chunks.to_pylist())


class _Plain:
    """Chunks that close one row and open the next, with nothing a lexer has to look at: most chunks of most files.

    They are told and cut by Arrow's own string functions, a whole batch at once."""

    def __init__(self, row_tag: str):
        self.tag, self.one = re.escape(row_tag), f"<{row_tag}"

    def records(self, chunks: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """Which chunks are plain, and the texts from their row tag on."""
        inside = pc.replace_substring_regex(chunks, r"^\s*>[^<]*", "")
        plain = pc.and_(pc.match_substring_regex(inside, rf"^<{self.tag}(\s[^<>\"']*[^<>\"'/])?>"), pc.equal(pc.count_substring(chunks, self.one), 1))
        plain = pc.and_(plain, pc.match_substring_regex(chunks, r"^\s*>"))
        return pc.and_not(plain, pc.match_substring_regex(chunks, "<[!?]")).to_numpy(zero_copy_only=False), inside


def _summaries(row_tag: str):
    def run(batches):
        lexer, plain, at, totals = RowLexer(row_tag), _Plain(row_tag), None, {}

        def rows():
            out = [(*at, s, e, c, o) for s, (e, (c, o)) in totals.items()]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SUMMARY, strict=True)], schema=_SUMMARY)

        for file, block, first, chunks in _parts(batches):
            if (file, block) != at:
                if at:
                    yield rows()
                at, totals = (file, block), {s: (s, (0, 0)) for s in (range(7) if block else (TEXT,))}
            # starts that have come to the same state go on alike
            step, whole = {}, None
            for state in {e for e, _ in totals.values()}:
                mark = {DOUBLE: '"', SINGLE: "'"}.get(state) or _END.get(state)
                if mark and not pc.any(pc.match_substring(chunks, mark)).as_py():
                    step[state] = state, (0, 0)
                elif state == TEXT and not first and plain.records(chunks)[0].all():
                    step[state] = TEXT, (1, 1)
                else:
                    whole = whole or _text(chunks, first, lexer.cut)
                    step[state] = _leftover(lexer, whole, state)
            totals = {s: (step[e][0], _compose(left, step[e][1])) for s, (e, left) in totals.items()}
        if at:
            yield rows()

    return run


_PLAN = "file long, block long, state int, depth long, rel long, row_block long, row_nr long, closes boolean"


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    """The splits of one file in order: real start state, open rows at the start, and the row that each leftover tag belongs to.

    Rows: one per split (rel -1), one per row that is open at a split's start and has text there (rel: how far up the stack),
    one per row that is opened there and not closed (rel -2, in order of opening), all with whether the row is closed anywhere.
    """
    state, stack, out, closed = TEXT, [], [], set()
    table = {(b, s): (e, c, o) for b, s, e, c, o in zip(rows["block"], rows["start"], rows["finish"], rows["closed"], rows["opened"], strict=True)}
    file = int(rows["file"].iloc[0])
    for block in sorted(set(rows["block"])):
        end, c, o = table[block, state]
        out.append((file, block, state, len(stack), -1, -1, -1, False))
        for r in range(min(c + 1, len(stack))):  # the row r up the stack has text here; it ends here if r < c
            out.append((file, block, state, len(stack), r, *stack[-1 - r], False))
        for _ in range(min(c, len(stack))):
            closed.add(stack.pop())
        for i in range(o):
            stack.append((block, i))
            out.append((file, block, state, 0, -2, block, i, False))
        state = end
    df = pd.DataFrame(out, columns=["file", "block", "state", "depth", "rel", "row_block", "row_nr", "closes"])
    df["closes"] = [(b, i) in closed for b, i in zip(df["row_block"], df["row_nr"], strict=True)]
    return df


_FOUND = pa.schema([("file", pa.int64()), ("row_block", pa.int64()), ("row_nr", pa.int64()), ("block", pa.int64()), ("text", pa.string()), ("kind", pa.int32())])
_FOUND_DDL = "file long, row_block long, row_nr long, block long, text string, kind int"

#: Kinds of found texts: a whole record, a piece of one, the head of a row that is never closed, what stands before a closing tag without a row.
RECORD, PIECE, UNCLOSED, HEADLESS = range(4)


class _Split:
    """The row elements of one split, from its real state. ``pieces``: only the texts of rows that cross its borders."""

    def __init__(self, lexer: RowLexer, file: int, block: int, plan: tuple, pieces: bool):
        self.lexer, self.file, self.block, self.pieces = lexer, file, block, pieces
        self.state, self.depth, self.open_rows, self.opened = plan
        self.stack: list[list[str]] = [[]]     # own texts; the first one is of what is open at the start
        self.closed = 0                        # closing tags of what was open at the start
        self.partial: str | None = None        # an opening tag's text so far, inside its quotes
        self.out: list[tuple] = []

    def feed(self, text: str) -> None:
        last = 0
        for kind, a, b in self.lexer.tags(text, self.state):
            if kind is None and b is None:
                self.state = a
            elif kind is None:                 # an opening tag goes on in the next part
                self.stack[-1].append(text[last:a])
                last = a
                self.partial = ""
            elif kind >= 0:
                if a >= 0:
                    self.stack[-1].append(text[last:a])
                    head = text[a:b]
                elif self.partial is not None:
                    head = self.partial + text[:b]
                else:                          # it began in an earlier split; its attributes aren't read
                    head = f"<{self.lexer.name}{'/' * (kind == 0)}>"
                self.partial, last = None, b
                self.stack.append([head])
                if kind == 0:
                    self._whole()
            else:
                self.stack[-1].append(text[last:b])
                last = b
                if len(self.stack) > 1:
                    self._whole()
                else:
                    self._close()
        if self.state not in (DOUBLE, SINGLE):
            self.stack[-1].append(text[last:])
        elif self.partial is not None:
            self.partial += text[last:]

    def add(self, chunks: pa.Array, first: bool, plain: _Plain):
        """Feed chunks; runs of plain ones come back as arrays of records."""
        easy, inside = plain.records(chunks)
        # borders between plain and other chunks; the first chunk of a split is lexed
        easy[0] = easy[0] and not first and len(self.stack) > 1
        edges = [0, *(np.flatnonzero(easy[1:] != easy[:-1]) + 1).tolist(), len(easy)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if not easy[a] or self.state != TEXT or len(self.stack) < 2 or b - a < 4:
                self.feed(_text(chunks[a:b], first and a == 0, self.lexer.cut))
                continue
            # each chunk's beginning closes the row before it
            self.stack[-1].append(f"{self.lexer.cut}>")
            self._whole()
            self.stack.append([inside[b - 1].as_py()])
            if not self.pieces and b - a > 1:
                yield pc.binary_join_element_wise(inside[a:b - 1], f"{self.lexer.cut}>", "")

    def _whole(self) -> None:
        own = self.stack.pop()
        if not self.pieces:
            self.out.append((self.file, -1, -1, self.block, "".join(own), RECORD))

    def _close(self) -> None:
        """A row of an earlier split ends here, or nothing was open."""
        text, self.stack[0] = "".join(self.stack[0]), []
        if self.closed < self.depth:
            self._piece(text)
        elif not self.pieces:
            self.out.append((self.file, -1, -1, self.block, text, HEADLESS))
        self.closed += 1

    def _piece(self, text: str) -> None:
        block, nr, closes = self.open_rows[self.closed]
        if closes and self.pieces:
            self.out.append((self.file, block, nr, self.block, text, PIECE))

    def finish(self) -> None:
        if self.closed < self.depth:
            self._piece("".join(self.stack[0]))
        for i, own in enumerate(self.stack[1:]):
            closes = self.opened.get((self.block, i), False)
            if closes == self.pieces:
                self.out.append((self.file, self.block, i, self.block, "".join(own), PIECE if closes else UNCLOSED))


def _finder(row_tag: str, plan, pieces: bool):
    def run(batches):
        lexer, plain, at, split = RowLexer(row_tag), _Plain(row_tag), None, None
        splits = plan.value

        def rows():
            found, split.out = split.out, []
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _FOUND, strict=True)], schema=_FOUND)

        for file, block, first, chunks in _parts(batches):
            if (file, block) != at:
                if split:
                    split.finish()
                    if split.out:
                        yield rows()
                at = (file, block)
                split = _Split(lexer, file, block, splits.get(at, (TEXT, 0, [], {})), pieces)
            for records in split.add(chunks, first, plain):
                m = len(records)
                yield pa.record_batch([pa.array(np.full(m, file)), pa.array(np.full(m, -1)), pa.array(np.full(m, -1)), pa.array(np.full(m, block)),
                                       records, pa.array(np.full(m, RECORD, np.int32))], schema=_FOUND)
            if split.out:
                yield rows()
        if split:
            split.finish()
            if split.out:
                yield rows()

    return run


def _borders(source: DataFrame, row_tag: str) -> dict:
    """Per split that needs it: its state, the rows open at its start and those that it leaves open."""
    # a row per split and state: the splits of a file are composed in one task
    planned = source.mapInArrow(_summaries(row_tag), _SUMMARY_DDL).groupBy("file").applyInPandas(_plan, _PLAN)
    plan: dict = {}
    for r in planned.where("rel <> -1 OR state <> 0 OR depth > 0").orderBy("file", "block", "rel").collect():
        known = plan.setdefault((r["file"], r["block"]), [r["state"], 0, [], {}])
        if r["rel"] == -2:
            known[3][r["row_block"], r["row_nr"]] = r["closes"]
        else:
            known[1] = r["depth"]
            if r["rel"] >= 0:
                known[2].append((r["row_block"], r["row_nr"], r["closes"]))
    return plan


def row_elements(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """``(text, kind)``: each row element's own text (RECORD), or the text of a fault (UNCLOSED, HEADLESS)."""
    from feedwright.sources.files import _bytes, largest_file
    ship_package(spark)
    fixed = with_fixed_splits(spark)
    source = fixed.read.option("lineSep", f"</{row_tag}").text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    # files that are one split each begin in text, outside every row
    split = largest_file(spark, path) > _bytes(fixed.conf.get("spark.sql.files.maxPartitionBytes"))
    borders = _borders(source, row_tag) if split else {}
    plan = spark.sparkContext.broadcast(borders)
    out = source.mapInArrow(_finder(row_tag, plan, False), _FOUND_DDL).select("text", "kind")
    if any(closes for _, _, rows, opened in borders.values() for closes in [*(r[2] for r in rows), *opened.values()]):
        out = out.unionByName(
            source.mapInArrow(_finder(row_tag, plan, True), _FOUND_DDL).groupBy("file", "row_block", "row_nr")
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "").alias("text"))
            .select("text", F.lit(RECORD).alias("kind")))
    return in_session(spark, out)
