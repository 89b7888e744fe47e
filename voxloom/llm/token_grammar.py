"""Token ids in binary shards under a Re-Pair grammar.

Documents in order of doc_id are encoded, each ends with an end id, and about
SHARD_TOKENS ids make a shard. In a shard the most frequent pairs of neighbours
become nonterminals, round after round until none occurs twice, in each round
all frequent pairs at once where they don't overlap; pairs never reach over the
end of a document. A shard
stores its rules with the length that each expands to, the remaining symbols,
and the number of ids before every STRIDE-th symbol, so any range of ids is
decoded without the rest.

A shard is one binary value:
  header     12 fields, see _HEADER
  documents  ids int64, null flags as bits, numbers of ids uint32
  rules      left uint32, right uint32, length uint32, rules per round uint32
  directory  ids before symbol 0, STRIDE, 2 STRIDE, ... uint32
  symbols    low 16 bits uint16, then the higher bits as planes of bits
"""

from __future__ import annotations

import functools
import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, materialize

END_ID = 2
SHARD_TOKENS = 1 << 18
#: A pair is frequent from this count on; a round makes so many rules at most, the others wait for the next.
LEAST_COUNT = 2
MOST_RULES = 1 << 14
STRIDE = 1024
#: Text that is encoded at a time.
TEXT_BYTES = 16 << 20
#: Stands behind each text: a byte that UTF-8 doesn't have.
TEXT_END = b"\xff"
#: Kinds of bytes. Those beyond ASCII count as letters at first; LOOSE ones are read with their neighbours only.
SPACE, LINE, LETTER, DIGIT, SIGN, LOOSE, END = range(7)
KINDS = bytes(
    END if c == 255 else LETTER if c > 127 or chr(c).isalpha() else DIGIT if 48 <= c <= 57
    else SPACE if c == 32 else LINE if c == 10 else LOOSE if c < 32 or c in (39, 127) else SIGN
    for c in range(256)
)
#: Whether a unit begins at a byte, by 8 times the kind of the byte before it and its own; 2: if no white space and no end follows.
BEGINS = bytes(
    1 if END in (a, b) else 2 if a <= LINE and b <= LINE else 0 if a == SPACE else a != b
    for a, b in (divmod(k % 64, 8) for k in range(256))
)
#: Units, and chunks, whose ids a worker remembers.
MOST_PIECES = 1_000_000
MAGIC, VERSION = b"VLRP", 1
_HEADER = struct.Struct("<4sHHIIIIIIIII")


def pair_rules(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """What is left of the ids, and (n, 2) pairs for each round; the i-th rule of all is symbol base + i.

    last marks the ids after which no pair may reach. Rounds end when no pair
    occurs LEAST_COUNT times without overlap. Of neighbouring pairs that overlap
    the more frequent one is replaced. A pair that isn't frequent never becomes
    so, nor does one of symbols that end and begin with its two, so its place is
    closed, and symbols between closed places are not looked at again.
    """
    full, rounds, n_rules = ids.astype(np.uint32), [], 0
    gone = np.zeros(len(full), bool)
    seq, at, last = full.copy(), np.arange(len(full)), last.copy()
    last[-1:] = True
    while True:
        stays = ~last
        stays[1:] |= stays[:-1]
        seq, at, last = _only(stays, seq, at, last)
        if not len(seq):
            break
        open_ = np.flatnonzero(~last)
        left, right = seq[open_], seq[open_ + 1]
        wide, place_bits = (base + n_rules).bit_length(), len(seq).bit_length()
        key = left.astype(np.uint64) << np.uint64(wide) | right
        # in a run of one symbol every other pair counts
        same = np.flatnonzero(left == right)
        skip = np.zeros(0, np.int64)
        if len(same):
            begins = np.flatnonzero(np.diff(open_[same], prepend=-2) != 1)
            place = np.arange(len(same)) - np.repeat(begins, np.diff(begins, append=len(same)))
            skipped = same[place & 1 == 1]
            skip, open_, key = open_[skipped], np.delete(open_, skipped), np.delete(key, skipped)
        if 2 * wide + place_bits <= 64:  # the place fits behind the pair, and numbers alone are sorted faster
            key = np.sort(key << np.uint64(place_bits) | open_.view(np.uint64))
            open_ = (key & np.uint64((1 << place_bits) - 1)).view(np.int64)
            key >>= np.uint64(place_bits)
        else:
            order = np.argsort(key)
            open_, key = open_[order], key[order]
        begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        count = np.diff(begins, append=len(key))
        by = np.flatnonzero(count >= LEAST_COUNT)
        by = by[np.argsort(-count[by], kind="stable")][:MOST_RULES]
        none = np.int32(len(by))
        rank = none + (count < LEAST_COUNT).astype(np.int32)
        rank[by] = np.arange(len(by), dtype=np.int32)
        mid = np.full(len(seq) + 1, none, np.int32)
        own = mid[1:]
        own[open_] = np.repeat(rank, count)
        rare = own > none
        own[rare] = none
        take = own < mid[:-1]
        take[:-1] &= own[:-1] < own[1:]
        chosen = np.flatnonzero(take)
        index = own[chosen]
        # what overlaps left to fewer waits
        worth = np.bincount(index, minlength=len(by)) >= LEAST_COUNT
        left_over = ~worth[index]
        if left_over.any():
            chosen = chosen[~left_over]
        last |= rare
        # a skipped place has the pair of the place before it, so it closes with that one
        last[skip] = last[skip - 1]
        if not len(chosen):
            continue
        number = np.cumsum(worth) - 1
        used = key[begins[by[worth]]]
        rounds.append((used[:, None] >> np.array([wide, 0], np.uint64) & np.uint64((1 << wide) - 1)).astype(np.uint32))
        seq[chosen] = (base + n_rules + number[own[chosen]]).astype(np.uint32)
        n_rules += len(used)
        full[at[chosen]] = seq[chosen]
        gone[at[chosen + 1]] = True
        last[chosen] = last[chosen + 1]
        keep = np.ones(len(seq), bool)
        keep[chosen + 1] = False
        seq, at, last = _only(keep, seq, at, last)
    return full[~gone], rounds


def _only(wanted: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """The rows that are wanted."""
    places = np.flatnonzero(wanted)
    return list(columns) if len(places) == len(wanted) else [c.take(places) for c in columns]


def write_shard(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, base: int) -> bytes:
    """One shard; ids are below base, lengths are the documents' numbers of ids."""
    ends = np.cumsum(lengths)
    last = np.zeros(len(ids), bool)
    last[ends[lengths > 0] - 1] = True
    seq, rounds = pair_rules(ids, last, base)
    rules = np.concatenate(rounds) if rounds else np.zeros((0, 2), np.uint32)
    size = np.ones(base + len(rules), np.uint32)
    done = base
    for r in rounds:
        size[done : done + len(r)] = size[r[:, 0]] + size[r[:, 1]]
        done += len(r)
    before = np.concatenate(([0], np.cumsum(size[seq], dtype=np.int64)))
    high = int(max(0, base + len(rules) - 1) >> 16).bit_length()
    planes = [np.packbits((seq >> np.uint32(16 + b)) & np.uint32(1)).tobytes() for b in range(high)]
    nulls = np.packbits(np.array([d is None for d in doc_ids], bool)).tobytes()
    directory = before[:-1][::STRIDE].astype(np.uint32)
    head = _HEADER.pack(MAGIC, VERSION, high, base, len(doc_ids), len(ids), len(rules), len(rounds), len(seq), STRIDE, len(directory), 0)
    parts = [
        head,
        np.array([d or 0 for d in doc_ids], np.int64).tobytes(),
        nulls,
        lengths.astype(np.uint32).tobytes(),
        rules[:, 0].tobytes(),
        rules[:, 1].tobytes(),
        size[base:].tobytes(),
        np.array([len(r) for r in rounds], np.uint32).tobytes(),
        directory.tobytes(),
        (seq & np.uint32(0xFFFF)).astype(np.uint16).tobytes(),
        *planes,
    ]
    return b"".join(parts)


class Shard:
    """A shard as read: documents, and any range of its ids."""

    def __init__(self, data: bytes):
        magic, version, high, self.base, n_docs, self.n_tokens, n_rules, n_rounds, self.n_symbols, self.stride, n_dir, _ = _HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a shard of this version")
        self._data, self._at = data, _HEADER.size
        ids = self._next(np.int64, n_docs)
        nulls = np.unpackbits(self._next(np.uint8, -(-n_docs // 8)), count=n_docs)
        self.doc_ids = [None if z else i for i, z in zip(ids.tolist(), nulls.tolist(), strict=True)]
        self.lengths = self._next(np.uint32, n_docs).astype(np.int64)
        self.left, self.right, size = (self._next(np.uint32, n_rules) for _ in range(3))
        self.rounds = self._next(np.uint32, n_rounds)
        self.directory = self._next(np.uint32, n_dir).astype(np.int64)
        self.symbols_at, self.high = self._at, high
        self.size = np.concatenate((np.ones(self.base, np.int64), size.astype(np.int64)))
        self.ends = np.concatenate(([0], np.cumsum(self.size)))
        self._expand_rules()

    def _next(self, kind, n: int) -> np.ndarray:
        out = np.frombuffer(self._data, kind, n, self._at)
        self._at += out.nbytes
        return out

    def _expand_rules(self) -> None:
        """The expansions of all symbols in one row of ids, in order; those of a round are made of earlier ones."""
        row, done = np.empty(int(self.ends[-1]), np.uint32), 0
        row[: self.base] = np.arange(self.base, dtype=np.uint32)
        for n in self.rounds.tolist():
            pairs = np.stack([self.left[done : done + n], self.right[done : done + n]], 1).ravel()
            a, b = self.ends[[self.base + done, self.base + done + n]]
            row[a:b] = self._spread(row, pairs)
            done += n
        self.row = row

    def _spread(self, row: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """What symbols expand to, from the expansions of all symbols up to the largest in a row."""
        ends = pa.py_buffer(4 * self.ends)
        all_ = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.size), [None, ends, pa.py_buffer(row)])
        found = all_.take(pa.array(symbols))
        return np.frombuffer(found.buffers()[2] or b"", np.uint32, int(self.size[symbols].sum()))

    def symbols(self, start: int, stop: int) -> np.ndarray:
        """Symbols start to stop; start is a multiple of 8."""
        out = np.frombuffer(self._data, np.uint16, stop - start, self.symbols_at + 2 * start).astype(np.uint32)
        plane = self.symbols_at + 2 * self.n_symbols
        for b in range(self.high):
            bits = np.frombuffer(self._data, np.uint8, -(-(stop - start) // 8), plane + start // 8)
            out |= np.unpackbits(bits, count=stop - start).astype(np.uint32) << np.uint32(16 + b)
            plane += -(-self.n_symbols // 8)
        return out

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop of the shard, from the symbols of their stretch alone."""
        stop = self.n_tokens if stop is None else stop
        if stop <= start:
            return np.zeros(0, np.uint32)
        a = max(0, int(np.searchsorted(self.directory, start, side="right")) - 1)
        b = int(np.searchsorted(self.directory, stop, side="left"))
        found = self._spread(self.row, self.symbols(a * self.stride, min(self.n_symbols, b * self.stride)))
        return found[start - self.directory[a] : stop - self.directory[a]]

    def document(self, i: int) -> np.ndarray:
        start = int(self.lengths[:i].sum())
        return self.ids(start, start + int(self.lengths[i]))


def splits_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer file is plain byte-level BPE: nothing is changed or added, no added token has or takes white space."""
    split, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    return (
        not any(spec.get(k) for k in ("normalizer", "truncation", "padding"))
        and split.get("type") == "ByteLevel"
        and split.get("use_regex", True)
        and not split.get("add_prefix_space")
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        and not any(t.get("lstrip") or t.get("rstrip") or t["content"].split() != [t["content"]] for t in spec.get("added_tokens") or [])
    )


class Encoder:
    """Ids of texts by a file of the tokenizers library.

    Byte-level splitting cuts a text where the kind of its characters changes,
    with a single space before what follows it, and of more white space the last
    one apart. So the ids of a text are those of such units, and units recur:
    each different one of a batch is looked up once, and encoded only if it is
    new. Where a unit is read with its neighbours (behind an apostrophe, with
    signs or digits beyond ASCII), its chunk is encoded as one, from a
    space up to the next. A text is encoded as a whole if such a chunk begins or
    ends with white space or the text has an added token, and so is every text if
    the file names another way of splitting (see `splits_at_spaces`).
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.base = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
        self.kind = np.uint16 if self.base <= 1 << 16 else np.uint32
        self.width = np.dtype(self.kind).itemsize
        self.end = np.array([end_id], self.kind).tobytes()
        with open(path, encoding="utf-8") as f:
            self.by_pieces = splits_at_spaces(json.load(f))
        if not self.by_pieces:
            return
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: In a byte-level vocabulary a character of a token stands for one byte.
        self.n_bytes = np.zeros(self.base, np.int64)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.n_bytes[i] = len(token)
        #: Ids of units, and of chunks with a space before them or none; empty for those that need their neighbours.
        self.units: dict[bytes, bytes] = {TEXT_END: self.end}
        self.chunks: dict[bytes, bytes] = {}

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _encode_behind(self, sign: str, words: list[str]) -> list[bytes]:
        """Ids of what follows a sign of one byte, encoded as one text and cut by the bytes that each id stands for.

        Behind a space its ids include the space, behind a line end they don't.
        """
        out: list[bytes] = []
        skip = 0 if sign == " " else self.width
        for i in range(0, len(words), 4000):
            some = words[i : i + 4000]
            text = sign + sign.join(some)
            if any(x in text for x in self.special):
                out += [x[skip:] for x in self._encode([sign + w for w in some])]
                continue
            (ids,) = self._encode([text])
            sizes = list(map(len, some)) if text.isascii() else [len(w.encode()) for w in some]
            ends = np.cumsum(self.n_bytes[np.frombuffer(ids, self.kind)])
            cuts = ((np.searchsorted(ends, np.cumsum(np.array(sizes) + 1)) + 1) * self.width).tolist()
            out += [ids[a + skip : b] for a, b in zip([0, *cuts], cuts, strict=False)]
        return out

    def _encode_units(self, units: list[bytes]) -> list[bytes]:
        """Ids of different units; empty for those that need their neighbours."""
        own = pa.array(units, pa.large_binary()).cast(pa.large_string())
        body = pc.utf8_ltrim(own, " ")
        word = pc.utf8_is_alpha(body).to_numpy(zero_copy_only=False)
        behind = pc.not_equal(own, body).to_numpy(zero_copy_only=False)
        plain = np.array([u.isascii() and KINDS[u[-1]] != LOOSE for u in units], bool)
        out = np.full(len(units), b"", object)
        for some, encode in (
            (word & behind, functools.partial(self._encode_behind, " ")),
            (word & ~behind, functools.partial(self._encode_behind, "\n")),
            (~word & plain, self._encode),
        ):
            if some.any():
                texts = own if encode == self._encode else body
                out[some] = encode(_values(texts.filter(pa.array(some))))
        return out.tolist()

    def _encode_chunks(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of different chunks; empty for those with white space at an end."""
        texts = [c.decode() for c in chunks]
        apart = [t.removeprefix(" ") for t in texts]
        plain = [i for i, t in enumerate(apart) if t and t == t.strip()]
        out = [b""] * len(texts)
        for i, ids in zip(plain, self._encode([texts[i] for i in plain]), strict=True):
            out[i] = ids
        return out

    def _look_up(self, known: dict[bytes, bytes], encode, keys: list[bytes]) -> list[bytes]:
        """Ids of different keys, of which known has those met before."""
        found = list(map(known.get, keys))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            todo = [keys[i] for i in new]
            made = encode(todo)
            for i, ids in zip(new, made, strict=True):
                found[i] = ids
            if len(known) < MOST_PIECES:
                known.update(zip(todo, made, strict=True))
        return found

    def _special(self, data: bytes):
        """Where added tokens stand."""
        for x in map(str.encode, self.special):
            at = data.find(x)
            while at >= 0:
                yield at
                at = data.find(x, at + 1)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (none is null) in a row, each text's with the end id, and each text's number of them."""
        if not self.by_pieces or not len(texts):
            whole = [ids + self.end for ids in self._encode(texts.to_pylist())]
            return np.frombuffer(b"".join(whole), self.kind), np.array(list(map(len, whole)), np.int64) // self.width
        data = TEXT_END.join([*texts.cast(pa.large_binary()).to_pylist(), b""])
        kinds = np.frombuffer(data.translate(KINDS), np.uint8)
        begins = np.empty(len(kinds), np.uint8)
        begins[0] = 1
        begins[1:] = np.frombuffer(((kinds[:-1] << 3) | kinds[1:]).tobytes().translate(BEGINS), np.uint8)
        doubtful = np.flatnonzero(begins == 2)
        after = kinds[doubtful + 1]
        begins[doubtful] = (after > LINE) & (after != END)
        starts = np.flatnonzero(begins)
        del begins
        first = kinds[starts]
        ends = np.flatnonzero(first == END)
        if len(ends) != len(texts):
            raise ValueError("a text isn't UTF-8")
        coded = _cut(data, starts).dictionary_encode()
        entry = coded.indices.to_numpy()
        ids = self._look_up(self.units, self._encode_units, _values(coded.dictionary))
        nothing = len(ids)
        ids.append(b"")
        odd = np.flatnonzero((np.fromiter(map(len, ids), np.int64, len(ids)) == 0)[entry])
        whole = {int(np.searchsorted(starts[ends], at)) for at in self._special(data)}
        if len(odd) or whole:
            entry = entry.copy()
        if len(odd):
            second = kinds[np.minimum(starts + 1, len(kinds) - 1)]
            cut = (first == SPACE) & (second > LINE) & (second != END)
            cut[0] = True
            cut[ends] = True
            cut[ends[:-1] + 1] = True
            cuts = np.flatnonzero(cut)
            del second, cut
            chunk = np.unique(np.searchsorted(cuts, odd, side="right") - 1)
            own = _cut(data, starts[cuts]).take(pa.array(chunk)).dictionary_encode()
            found = self._look_up(self.chunks, self._encode_chunks, _values(own.dictionary))
            number = own.indices.to_numpy()
            apart = np.array([not x for x in found], bool)[number]
            whole.update(np.searchsorted(ends, cuts[chunk[apart]]).tolist())
            n = cuts[chunk + 1] - cuts[chunk]
            inside = np.arange(n.sum()) + np.repeat(cuts[chunk] - np.cumsum(n) + n, n)
            entry[inside] = nothing
            entry[cuts[chunk]] = len(ids) + number
            ids += found
        for i, own in zip(sorted(whole), self._encode([texts[i].as_py() for i in sorted(whole)]), strict=True):
            a = ends[i - 1] + 1 if i else 0
            entry[a : ends[i]] = nothing
            entry[a] = len(ids)
            ids.append(own)
        joined = pa.array(ids, pa.large_binary()).take(pa.array(entry))
        done = np.frombuffer(joined.buffers()[1], np.int64, len(entry) + 1) // self.width
        return np.frombuffer(joined.buffers()[2], self.kind, int(done[-1])), np.diff(done[ends + 1], prepend=0)


def _values(column: pa.Array) -> list:
    """column.to_pylist() in one step, for texts and bytes."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _cut(data: bytes, starts: np.ndarray) -> pa.Array:
    """Bytes cut at starts, of which the first is 0."""
    offsets = np.append(starts, len(data))
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


@functools.cache
def encoder(path: str, end_id: int) -> Encoder:
    """One for each worker, so that the tasks that follow each other in it load the file and meet the pieces once."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, end_id)


def _together(batches, limit: int):
    """(ids, texts) of batches, null texts as empty ones, as many as have about `limit` bytes."""
    ids: list = []
    texts: list[pa.Array] = []
    size = 0
    for batch in batches:
        for own in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
            ids += own.column(0).to_pylist()
            texts.append(pc.fill_null(own.column(1), "").cast(pa.large_string()))
            size += pc.sum(pc.binary_length(texts[-1])).as_py() or 0
            if size >= limit:
                yield ids, pa.concat_arrays(texts)
                ids, texts, size = [], [], 0
    if ids:
        yield ids, pa.concat_arrays(texts)


def token_shards(docs: DataFrame, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """part, shard, n_tokens, data: all documents as shards, in order of part, shard and place; written to the shared folder.

    Documents are dealt out by ranges of doc_id and a hash of the text, so that
    many of one id or none make no large part; null ids come last.
    """

    def write(batches):
        from pyspark import TaskContext

        part, number, encode = TaskContext.get().partitionId(), 0, encoder(path, end_id)
        doc_ids: list = []
        lengths: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def row():
            data = write_shard(doc_ids, np.array(lengths, np.int64), np.concatenate(held), encode.base)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([data], pa.binary())],
                ["part", "shard", "n_tokens", "data"],
            )

        for ids, texts in _together(batches, TEXT_BYTES):
            found, n = encode(texts)
            done = np.concatenate(([0], np.cumsum(n)))
            a = 0
            while a < len(n):  # up to the document that fills the shard
                b = min(len(n), int(np.searchsorted(done, done[a] + shard_tokens - size)))
                doc_ids += ids[a:b]
                lengths += n[a:b].tolist()
                held.append(found[done[a] : done[b]])
                size += int(done[b] - done[a])
                a = b
                if size >= shard_tokens:
                    yield row()
                    doc_ids, lengths, held, size, number = [], [], [], 0, number + 1
        if lengths:
            yield row()

    key = [F.col("doc_id").asc_nulls_last(), F.col("salt")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("salt"))
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key).select("doc_id", "text")
    return materialize(map_batches(rows, write, "part int, shard int, n_tokens long, data binary"), "token-shards")


def _documents(batches):
    for batch in batches:
        for part, number, data in zip(*[batch.column(i).to_pylist() for i in (0, 1, 2)], strict=True):
            shard = Shard(data)
            ids = shard.ids().astype("<u4")
            ends = np.cumsum(shard.lengths)
            begins = ends - shard.lengths
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * n, pa.int32()),
                    pa.array([number] * n, pa.int32()),
                    pa.array(shard.doc_ids, pa.int64()),
                    pa.array(begins),
                    pa.array(shard.lengths),
                    pa.array(crc, pa.int64()),
                ],
                ["part", "shard", "doc_id", "begin", "n_tokens", "ids_crc32"],
            )


def read_back(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, decoded from the shards."""
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    starts = sizes.withColumn("own", own).join(parts, "part").select("part", "shard", (F.col("part_start") + F.col("own")).alias("base"))
    kinds = "part int, shard int, doc_id long, begin long, n_tokens long, ids_crc32 long"
    found = map_batches(shards.select("part", "shard", "data"), _documents, kinds)
    return found.join(starts, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: a row for each row of docs, read back from the shards.

    Null and empty texts have the end id alone. Repeated rows are documents of
    their own; rows of one id stand in order of a hash of the text, null ids
    last. An empty table gives no rows. Other columns are not looked at.
    """
    return read_back(token_shards(docs, path, end_id, shard_tokens))
