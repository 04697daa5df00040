"""Encoding and decoding by a word-level BPE file, with tree concatenation of long texts.

A long text is cut into halves, and these again, down to leaves that tasks encode in parallel.
Two neighbours are then joined: a window around their join is encoded again and grows until its
tokens agree with the left side's at one end and with the right side's at the other; what lies
between comes from the window. Pieces between spaces are encoded once and kept.
"""

from __future__ import annotations

import hashlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import materialize, slices
from .tokens import load, plain, tokenizer_path

LEAF = 1 << 15
WINDOW = 32
#: The tokenizer's own splitting pattern (a fixed value).
_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


@dataclass
class Piece:
    """A text with its tokens: ids, and the first and last-plus-one character of each."""

    text: str
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def tokens(self, lo: int, hi: int, shift: int = 0) -> list[tuple[int, int, int]]:
        """(id, start, end) of tokens lo to hi, their characters moved by shift."""
        return list(zip(self.ids[lo:hi].tolist(), (self.starts[lo:hi] + shift).tolist(), (self.ends[lo:hi] + shift).tolist()))


def encode_piece(tokenizer, text: str) -> Piece:
    e = tokenizer.encode(text, add_special_tokens=False)
    spans = np.array(e.offsets, np.int64).reshape(-1, 2)
    return Piece(text, np.array(e.ids, np.uint32), spans[:, 0], spans[:, 1])


def _common(side: list[tuple], window: list[tuple], last: bool) -> tuple[int, int] | None:
    """(i, j) with side[i:i+2] == window[j:j+2]; the last such j if asked, else the first."""
    at = {pair: i for i, pair in enumerate(zip(side, side[1:]))}
    found = [(at[pair], j) for j, pair in enumerate(zip(window, window[1:])) if pair in at]
    return (found[-1] if last else found[0]) if found else None


def concatenate(tokenizer, a: Piece, b: Piece, window: int = WINDOW) -> Piece:
    """The tokens of a.text + b.text from those of both.

    A window's ends are cuts too, so its outer tokens may be wrong; where two tokens in a row
    are the same, with the same characters, in the side and in the window, the side's tokens
    up to there and the window's from there on are a valid encoding. A window holds any special
    token that the cut may have parted. One that reaches the end of the text needs no agreement
    there, so the loop ends. Only tokens near the join are looked at.
    """
    cut, size = len(a.text), len(a.text) + len(b.text)
    window = max([window, *(len(t.content) + 2 for t in tokenizer.get_added_tokens_decoder().values())])
    while True:
        lo, hi = max(0, cut - window), min(size, cut + window)
        w = encode_piece(tokenizer, a.text[lo:] + b.text[: hi - cut])
        middle = w.tokens(0, len(w.ids), lo)
        skipped = 0 if lo == 0 else max(0, len(a.ids) - 4 * window)
        near = (0, 0) if lo == 0 else _common(a.tokens(skipped, len(a.ids)), middle, False)
        far = (len(b.ids), len(middle)) if hi == size else _common(b.tokens(0, 4 * window, cut), middle, True)
        if near and far and near[1] <= far[1]:
            kept, inner, rest = slice(0, skipped + near[0]), slice(near[1], far[1]), slice(far[0], None)
            join = lambda x, y, z: np.concatenate((x[kept], y[inner], z[rest]))
            return Piece(
                a.text + b.text, join(a.ids, w.ids, b.ids), join(a.starts, w.starts + lo, b.starts + cut), join(a.ends, w.ends + lo, b.ends + cut)
            )
        window *= 2


def halves(length: int, leaf: int = LEAF) -> list[int]:
    """Borders of the leaves of a text: halves of halves until a part has at most leaf characters."""
    parts = 1
    while -(-length // parts) > leaf:
        parts *= 2
    return [length * i // parts for i in range(parts + 1)]


def encode_tree(tokenizer, text: str, leaf: int = LEAF, window: int = WINDOW) -> Piece:
    """text encoded by tree concatenation in one process."""
    borders = halves(len(text), leaf)
    level = [encode_piece(tokenizer, text[a:b]) for a, b in zip(borders, borders[1:])]
    while len(level) > 1:
        level = [concatenate(tokenizer, level[i], level[i + 1], window) for i in range(0, len(level), 2)]
    return level[0]


class Words:
    """Tokens of the parts between spaces: part -> (ids as bytes, ids in decimal, decoded)."""

    def __init__(self, path: str, keep: int = 500_000):
        self.tokenizer, self.keep, self.known = load(path), keep, {}
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.last = np.array([t.endswith("</w>") for t in tokens])
        self.decimal = [b"%d" % i for i in range(len(tokens))]
        self.decoded = [t.encode() for t in tokens] if self.tokenizer.decoder is None else None  # then tokens are joined by spaces

    def entry(self, ids: list[int]) -> tuple[bytes, bytes, bytes]:
        """(ids as bytes, ids in decimal, decoded text) of the tokens of whole parts."""
        if self.decoded is not None:
            decoded = b" ".join([self.decoded[i] for i in ids])
        else:
            decoded = self.tokenizer.decode(ids, skip_special_tokens=False).encode()
        return array("I", ids).tobytes(), b" ".join([self.decimal[i] for i in ids]), decoded

    def learn(self, parts: set[str]) -> None:
        new = [p for p in parts if p not in self.known]
        if len(self.known) + len(new) > self.keep:
            self.known.clear()
            new = list(parts)
        short = [p for p in new if plain(p)]
        counts = [len(_PRETOKEN.findall(p.lower())) for p in short]
        for lo in range(0, len(short), 256):  # many parts at a time: a part has as many word ends as pretokens
            some, n = short[lo : lo + 256], np.cumsum(counts[lo : lo + 256])
            ids = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.last[ids]) + 1 if ids else np.zeros(0, int)
            if len(ends) != n[-1]:
                new += some
                continue
            ends = np.concatenate(([0], ends))[n].tolist()
            begin = 0
            for p, end in zip(some, ends):
                self.known[p] = self.entry(ids[begin:end])
                begin = end
        rest = [p for p in new if p not in self.known]
        for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.known[p] = self.entry(e.ids)

    def entries(self, texts: list[str]) -> list[list[tuple]]:
        """For each text the entries of its parts that have tokens."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        self.learn({p for parts in split for p in parts if p not in self.known})
        known = self.known
        out = []
        for parts in split:
            try:
                out.append([e for e in map(known.__getitem__, parts) if e[0]])
            except KeyError:  # forgotten meanwhile
                self.learn(set(parts))
                out.append([e for e in map(known.__getitem__, parts) if e[0]])
        return out

    def leaf(self, text: str) -> tuple[Piece | None, list[tuple], Piece]:
        """A leaf's tokens: the open piece before its first space, the closed middle, and the open piece after its last space.

        Without a space the whole leaf is open: the first piece is None then.
        """
        first, space, rest = text.partition(" ")
        if not space:
            return None, [], encode_piece(self.tokenizer, text)
        middle, _, last = rest.rpartition(" ")
        return encode_piece(self.tokenizer, first), self.entries([middle])[0], encode_piece(self.tokenizer, last)


_words: dict[str, Words] = {}


def _known(path: str) -> Words:
    if path not in _words:  # kept from task to task
        _words[path] = Words(path)
    return _words[path]


def _columns(entries: list[list[tuple]], full: bool) -> list[pa.Array]:
    ids = [b" ".join([e[1] for e in parts]) for parts in entries]
    decoded = [b" ".join([e[2] for e in parts]) for parts in entries]
    n = [sum([len(e[0]) for e in parts]) // 4 for parts in entries]
    out = [
        pa.array(n, pa.int64()),
        pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
        pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
    ]
    if full:
        flat = b"".join([e[0] for parts in entries for e in parts])
        out.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(np.frombuffer(flat, "<i4"))))
        out.append(pa.array([x.decode() for x in decoded], pa.string()))
    return out


def cut_leaves(text: str, leaf: int) -> list[tuple[str, int, int, int, int]]:
    """(part, run, at, of, of_next) of every leaf of a text.

    Leaves meet at cuts that no space need mark. What lies between two spaces of the text, over
    any number of cuts, is a run: a leaf's part before its first space belongs to run `run` as
    its piece number `at`, and its part after its last space opens the next run. of and of_next
    are the numbers of pieces of these two runs; a leaf without a space is one piece of its run.
    """
    borders = halves(len(text), leaf)
    parts, places, sizes, run = [text[a:b] for a, b in zip(borders, borders[1:])], [], [0], 0
    for part in parts:
        places.append((run, sizes[run]))
        sizes[run] += 1
        if " " in part:
            run += 1
            sizes.append(1)
    return [(part, run, at, sizes[run], sizes[run + 1] if run + 1 < len(sizes) else 0) for part, (run, at) in zip(parts, places)]


_PIECE = pa.schema(
    [("copy", pa.int64()), ("run", pa.int32()), ("at", pa.int32()), ("of", pa.int32()), ("text", pa.string()), ("ids", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary())]
)
_PIECE_SQL = "copy bigint, run int, at int, of int, text string, ids binary, starts binary, ends binary"


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (copy, run, at, of, Piece) as a batch; at is null for the closed tokens between two runs."""
    columns = list(zip(*rows)) if rows else [()] * 5
    found = columns[4]
    body = [[p.text for p in found], [p.ids.astype("<u4").tobytes() for p in found], [p.starts.astype("<i8").tobytes() for p in found], [p.ends.astype("<i8").tobytes() for p in found]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns[:4], *body], _PIECE)], schema=_PIECE)


def _piece(row: dict) -> Piece:
    return Piece(row["text"], np.frombuffer(row["ids"], "<u4"), np.frombuffer(row["starts"], "<i8"), np.frombuffer(row["ends"], "<i8"))


def _tree(pieces: DataFrame, path: str, window: int) -> DataFrame:
    """The pieces of every run joined into one, pair by pair and level by level; runs that are whole leave the levels."""

    def join(pair: pa.Table) -> pa.Table:
        rows = sorted(pair.to_pylist(), key=lambda r: r["at"])
        made = _piece(rows[0])
        if len(rows) == 2:
            made = concatenate(_known(path).tokenizer, made, _piece(rows[1]), window)
        first = rows[0]
        return pa.Table.from_batches([_pieces([(first["copy"], first["run"], first["at"] // 2, (first["of"] + 1) // 2, made)])])

    left = pieces.agg(F.max("of").alias("n")).first()["n"] or 0
    whole, open_ = [pieces.where("at is null or of = 1")], pieces.where("at is not null and of > 1")
    while left > 1:
        level = open_.groupBy("copy", "run", F.expr("at div 2").alias("pair")).applyInArrow(join, _PIECE_SQL)
        level = materialize(level, "level")
        whole.append(level.where("of = 1"))
        open_, left = level.where("of > 1"), (left + 1) // 2
    out = whole[0]
    for w in whole[1:]:
        out = out.unionByName(w)
    return out


def encode_decode(
    docs: DataFrame,
    tokenizer: str | None = None,
    full: bool = True,
    leaf: int = LEAF,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) of every whole text.

    The ids are the tokenizer library's without special tokens added, and decoded is what it
    makes of them with none skipped. Texts of up to `leaf` characters are encoded where they are
    read. Longer ones are cut into leaves, which all tasks share; what no space parts is joined
    as a tree, one level after another, and a text's tokens are read in order, piece by piece,
    to make its row (with full, that one row holds them all). docs is read once: rows are
    numbered, encoded or cut, and written to the shared folder, so it may be any DataFrame.

    A null or empty text has no tokens. Repeated rows give repeated results, null ids stay null;
    extra columns, whatever their names, are ignored; an empty table stays empty.
    """
    path = tokenizer or tokenizer_path("word_bpe_49k.json")
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * full
    types = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32()), pa.string()] * full
    result = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * full
    place = ["part", "run", "at", "of", "of_next"]
    place_types = [pa.string(), *[pa.int32()] * 4]

    def scan(batches):
        words = _known(path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in slices([len(t) for t in texts], 2 << 20):
                short = [i for i in range(lo, hi) if len(texts[i]) <= leaf]
                if short:
                    made = _columns(words.entries([texts[i] for i in short]), full)
                    own = [batch.column(c).take(pa.array(short)) for c in ("id", "copy")]
                    yield pa.RecordBatch.from_arrays([*own, *(pa.nulls(len(short), t) for t in place_types), *made], ["id", "copy", *place, *names])
                for i in range(lo, hi):
                    if len(texts[i]) > leaf:
                        parts = cut_leaves(texts[i], leaf)
                        for a, b in slices([len(p[0]) for p in parts], 2 << 20):
                            own = [batch.column(c).take(pa.array([i] * (b - a))) for c in ("id", "copy")]
                            cut = [pa.array(c, t) for c, t in zip(zip(*parts[a:b]), place_types)]
                            yield pa.RecordBatch.from_arrays([*own, *cut, *(pa.nulls(b - a, t) for t in types)], ["id", "copy", *place, *names])

    def encode(batches):
        words = _known(path)
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                first, middle, last = words.leaf(row["part"])
                if first is None:
                    yield _pieces([(row["copy"], row["run"], row["at"], row["of"], last)])
                    continue
                closed = Piece("", np.frombuffer(b"".join(e[0] for e in middle), np.uint32), nothing, nothing)
                yield _pieces(
                    [(row["copy"], row["run"], row["at"], row["of"], first), (row["copy"], row["run"], None, 1, closed), (row["copy"], row["run"] + 1, 0, row["of_next"], last)]
                )

    def finish(batches):
        words, at = _known(path), None

        def row():
            out = [pa.array([at], pa.int64()), pa.array([n], pa.int64()), pa.array([ids.hexdigest()]), pa.array([text.hexdigest()])]
            if full:
                out += [pa.array([np.concatenate(kept) if kept else []], pa.list_(pa.int32())), pa.array([b" ".join(said).decode()])]
            return pa.RecordBatch.from_arrays(out, ["copy", *names])

        for batch in batches:
            for copy, data in zip(batch.column("copy").to_pylist(), batch.column("ids").to_pylist()):
                if copy != at:
                    if at is not None:
                        yield row()
                    at, n, ids, text, kept, said = copy, 0, hashlib.sha256(), hashlib.sha256(), [], []
                some = np.frombuffer(data, "<u4")
                for lo in range(0, len(some), 1 << 16):  # whole parts only if the decoder joins parts by spaces: then any cut will do
                    raw, decimal, decoded = words.entry(some[lo : lo + (1 << 16)].tolist()) if words.decoded is not None else words.entry(some.tolist())
                    ids.update(b" " * (n > 0) + decimal)
                    text.update(b" " * (n > 0) + decoded)
                    n += len(raw) // 4
                    if full:
                        kept.append(np.frombuffer(raw, "<u4"))
                        said.append(decoded)
                    if words.decoded is None:
                        break
        if at is not None:
            yield row()

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("copy"), F.col(text_col).alias("text"))
    scanned = materialize(rows.mapInArrow(scan, f"id {kind}, copy bigint, part string, run int, at int, of int, of_next int, {result}"), "encoded")
    near, leaves = scanned.where("part is null").select("id", *names), scanned.where("part is not null")
    dealt = leaves.select("copy", *place).repartition(F.xxhash64("copy", "run", "at")).mapInArrow(encode, _PIECE_SQL)
    runs = _tree(materialize(dealt, "pieces"), path, window)
    # closed tokens come behind their run and before the next
    ordered = runs.select("copy", (2 * F.col("run") + F.col("at").isNull().cast("int")).alias("place"), "ids").repartition("copy").sortWithinPartitions("copy", "place")
    far = ordered.mapInArrow(finish, "copy bigint, " + result)
    return near.unionByName(leaves.where("run = 0 and at = 0").select("id", "copy").join(far, "copy").drop("copy"))
