"""Token-id shards under Re-Pair grammar compression (operator 1).

Documents are range-partitioned by id, encoded inside Arrow batches and stored as shards: one row per shard with its
grammar (rules and the number of token ids each symbol stands for) and the remaining symbols. The table is the file
format; Spark's writer commits it, so lost executors cost a retry and no half-written shard.

Shard columns: ``part`` and ``shard`` (order of the shards), ``doc_ids``, ``n_tokens`` (ids per document, end id
included), ``n_symbols`` (symbols per document), ``base`` (symbols below it are token ids), ``rules`` (uint32 pairs:
symbol ``base + i`` stands for the i-th pair), ``lengths`` (uint32: ids that each rule expands to), ``width`` (bytes of a
symbol) and ``symbols`` (little-endian). No pair spans the end of a document, so each document is a run of whole symbols
and a token range is found by adding lengths, without expanding what lies before it.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, prepare, releasing, shared_path, table

END_ID = 1
SHARD_TOKENS, SLICE_BYTES = 1_500_000, 3 << 20
FIRST_PAIRS, MIN_COUNT = 8000, 16
KNOWN_UNITS = 1_500_000


def _hashes(units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every string, byte by byte over all strings at once; the few long ones by themselves."""
    units = units.cast(pa.large_string())
    ends = np.frombuffer(units.buffers()[1], np.int64)[units.offset:units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)
    size = np.diff(ends)
    order = np.argsort(-size, kind="stable")
    start, longest = ends[:-1][order], size[order]
    a, b = longest.astype(np.uint64) + np.uint64(0xCBF29CE484222325), longest.astype(np.uint64)
    for j in range(min(64, int(longest[0]) if len(longest) else 0)):
        k = int(np.searchsorted(-longest, -j, "left"))                       # strings longer than j bytes
        byte = data[start[:k] + j]
        a[:k] = (a[:k] ^ byte) * np.uint64(0x100000001B3)
        b[:k] = (b[:k] + byte + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(int(np.searchsorted(-longest, -64, "left"))):
        text = data[start[i]:start[i] + longest[i]].tobytes()
        a[i], b[i] = xxhash.xxh64_intdigest(text, 1), xxhash.xxh64_intdigest(text, 2)
    out = np.empty((2, len(units)), np.uint64)
    out[:, order] = a ^ (a >> np.uint64(31)), b ^ (b >> np.uint64(29))
    return out[0], out[1]


class WordEncoder:
    """Whole texts to ids, for tokenizers that drop white space, lower-case, split letters from signs and mark word ends.

    The ids of a text are then those of its words in turn, and those of a word that ends in signs are those of its front
    and of its signs, provided that the front still ends in a letter once the tokenizer has normalised it (a letter that
    becomes two characters, as a dotted capital I does, would leave a mark to be grouped with the signs). Units seen before are looked up (by a 128-bit hash, in sorted arrays), so the tokenizer encodes each
    distinct unit once; about ``KNOWN_UNITS`` are remembered. Runs of letters are encoded many at a time and told apart by
    the ids that end a word; any other unit is encoded by itself, and so is a run whose ends don't add up.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.vocabulary = max(vocabulary.values()) + 1
        self.ends_word = np.zeros(self.vocabulary, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.stays_letter: dict[str, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.first, self.second = np.empty(0, np.uint64), np.empty(0, np.uint64)      # hashes, ordered by the first
        self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int32)          # the unit's place among the ids
        self.ids = np.empty(0, np.uint32)

    def _is_whole(self, letter: str) -> bool:
        """Does the normalised form of a word that ends in ``letter`` end in a letter?"""
        if letter not in self.stays_letter:
            last = self.tokenizer.normalizer.normalize_str("x" + letter)[-1] if self.tokenizer.normalizer else letter
            self.stays_letter[letter] = unicodedata.category(last)[0] == "L"
        return self.stays_letter[letter]

    def _one_by_one(self, units: list[str]):
        done = self.tokenizer.encode(units, is_pretokenized=True, add_special_tokens=False)
        return np.array(done.ids, np.uint32), np.bincount(np.array(done.word_ids, np.int64), minlength=len(units))

    def _letters(self, units: list[str]):
        ids = np.array(self.tokenizer.encode("\n".join(units), add_special_tokens=False).ids, np.uint32)
        stops = np.flatnonzero(self.ends_word[ids]) + 1
        if len(stops) != len(units) or stops[-1] != len(ids):
            return self._one_by_one(units)
        return ids, np.diff(stops, prepend=0)

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Place and size, among the ids, of units that were not known; their ids are appended."""
        texts = units.to_pylist()
        plain = pc.match_substring_regex(units, r"^\pL+$").to_numpy(zero_copy_only=False)
        order = np.argsort(~plain, kind="stable")
        ids, counts = [], np.empty(len(texts), np.int64)
        for mine, encode, step in ((order[:plain.sum()], self._letters, 128), (order[plain.sum():], self._one_by_one, 1024)):
            for at in range(0, len(mine), step):
                got, counts[mine[at:at + step]] = encode([texts[i] for i in mine[at:at + step]])
                ids.append(got)
        start = np.empty(len(texts), np.int64)                # ids lie in the order of encoding
        start[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.ids = np.concatenate([self.ids, *ids])
        return start, counts

    def _places(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Place and size, among the ids, of every unit."""
        coded = units.dictionary_encode()
        first, second = _hashes(coded.dictionary)
        at = np.searchsorted(self.first, first)
        near = np.minimum(at, max(0, len(self.first) - 1))
        same = self.first[near] == first if len(self.first) else np.zeros(len(first), bool)
        known = same & (self.second[near] == second) if len(self.first) else same
        start, size = np.empty(len(first), np.int64), np.empty(len(first), np.int64)
        start[known], size[known] = self.start[near[known]], self.size[near[known]]
        new = np.flatnonzero(~known)
        if len(new):
            start[new], size[new] = self._encode_units(coded.dictionary.take(pa.array(new)))
            fresh = new[~same[new]]                            # one first hash, one entry
            fresh = fresh[np.unique(first[fresh], return_index=True)[1]]
            for name, values in (("second", second), ("start", start), ("size", size), ("first", first)):
                setattr(self, name, np.insert(getattr(self, name), at[fresh], values[fresh]))
        index = coded.indices.to_numpy()
        return start[index], size[index]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, END_ID after each, and the number of ids of each text (null: no words)."""
        if len(self.first) > KNOWN_UNITS:
            self._forget()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        n_words = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        words = pc.if_else(pc.match_substring(words, "<|"), words, pc.ascii_lower(words))   # special tokens keep their case
        cut = pc.extract_regex(words, r"^(?P<front>.*\pL)(?P<signs>[.,;:!?%#$&*]+)$")
        front, signs = pc.struct_field(cut, "front"), pc.struct_field(cut, "signs")
        last = pc.utf8_slice_codeunits(front, -1)
        whole = pc.is_in(last, value_set=pa.array([c for c in pc.unique(last).to_pylist() if c and self._is_whole(c)], last.type))
        front = self._places(pc.coalesce(pc.if_else(whole, front, None), words))
        signs = self._places(pc.fill_null(pc.if_else(whole, signs, None), ""))
        starts, size = np.stack([front[0], signs[0]], 1), np.stack([front[1], signs[1]], 1)
        of_word = _gather(self.ids, starts.reshape(-1), size.reshape(-1))
        size = size.sum(1)
        starts, at = np.cumsum(size) - size, coded.indices.to_numpy()
        lens = size[at]
        upto = np.concatenate(([0], np.cumsum(lens)))[np.cumsum(n_words)]
        return np.insert(_gather(of_word, starts[at], lens), upto, END_ID), np.diff(upto, prepend=0) + 1


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, so words stay known from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _gather(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lens[i]] for every i, one after the other; a million values at a time."""
    stops = np.cumsum(lens)
    out = np.empty(int(stops[-1]) if len(stops) else 0, values.dtype)
    at = done = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(stops, done + (1 << 20), "right")))
        n, stop = lens[at:end], int(stops[end - 1])
        out[done:stop] = values[np.repeat(starts[at:end] - stops[at:end] + n + done, n) + np.arange(stop - done)]
        at, done = end, stop
    return out


# ------------------------------------------------------------------------------------------------ grammar

def repair(ids: np.ndarray, ends: np.ndarray, base: int, rounds: int | None = None, pairs: int = FIRST_PAIRS,
           min_count: int = MIN_COUNT):
    """Re-Pair in rounds: (symbols, symbols per run, rules, lengths) for ``ids`` cut into runs at ``ends``.

    A round counts adjacent pairs within runs, gives the most frequent that occur at least ``min_count`` times a
    nonterminal (``pairs`` of them, twice as many in each round after), and replaces their occurrences from left to
    right without overlap, until no pair is frequent (or for ``rounds``). Only the first round counts all pairs: a pair's count falls unless
    a new symbol comes into it, so later ones look at the places of pairs that were frequent and of those beside new symbols.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[ends - 1] = True
    rules, lengths = [np.empty((0, 2), np.uint32)], [np.ones(base, np.int64)]
    known, symbols, done = {}, base, 0
    hot = ~last
    while rounds is None or done < rounds:
        at = np.flatnonzero(hot & ~last)
        at = at[at < len(seq) - 1]
        bucket = (seq[at] * np.uint32(0x9E3779B1) + seq[at + 1] * np.uint32(0x85EBCA77)) >> np.uint32(12)
        rich = np.bincount(bucket, minlength=1 << 20) >= min_count          # no frequent pair is lost: it fills its bucket
        at = at[rich[bucket]]
        code = (seq[at].astype(np.uint64) << np.uint64(32)) | seq[at + 1]
        found, which, count = np.unique(code, return_inverse=True, return_counts=True)
        frequent = count >= min_count
        best = np.flatnonzero(frequent)
        best = best[np.argsort(-count[best], kind="stable")[:pairs]]
        if not len(best):
            break
        hot[:] = False
        hot[at[frequent[which]]] = True
        symbol = np.full(len(found), -1, np.int64)
        chosen = found[best].tolist()
        symbol[best] = [known.get(pair, -1) for pair in chosen]              # left over where occurrences overlapped
        new_pairs = best[symbol[best] < 0]
        symbol[new_pairs] = symbols + np.arange(len(new_pairs))
        known.update(zip(found[new_pairs].tolist(), symbol[new_pairs].tolist()))
        symbols, pairs, done = symbols + len(new_pairs), 2 * pairs, done + 1
        pair = np.stack([found[new_pairs] >> np.uint64(32), found[new_pairs] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        size = np.concatenate(lengths)
        lengths, rules = [size, size[pair].sum(1)], [*rules, pair]
        new = symbol[which]
        at, new = at[new >= 0], new[new >= 0]
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
        take = ((np.arange(len(at)) - run) & 1) == 0                    # every other one of a row of overlapping pairs
        at, new = at[take], new[take]
        seq[at] = new
        last[at] = last[at + 1]
        hot[at] = True
        hot[at[at > 0] - 1] = True
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last, hot = seq[keep], last[keep], hot[keep]
    stops = np.flatnonzero(last) + 1
    return seq, np.diff(stops, prepend=0), np.concatenate(rules), np.concatenate(lengths)[base:]


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The token ids that ``symbols`` stand for."""
    wide = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])
    stops = np.cumsum(wide)
    flat = np.empty(int(stops[-1]) if len(stops) else 0, np.uint32)
    flat[:base] = np.arange(base)
    todo = np.arange(len(rules))
    done = np.concatenate([np.ones(base, bool), np.zeros(len(rules), bool)])
    while len(todo):                                     # rules whose parts are known, level by level
        ready = done[rules[todo]].all(1)
        now, todo = todo[ready], todo[~ready]
        parts = rules[now].reshape(-1).astype(np.int64)
        out = _gather(flat, stops[parts] - wide[parts], wide[parts])
        into = np.repeat(stops[base + now] - wide[base + now] - np.cumsum(wide[base + now]) + wide[base + now],
                         wide[base + now]) + np.arange(len(out))
        flat[into] = out
        done[base + now] = True
    at = symbols.astype(np.int64)
    return _gather(flat, stops[at] - wide[at], wide[at])


def decode_range(shard: dict, doc: int, start: int, stop: int) -> np.ndarray:
    """Token ids [start, stop) of the shard's ``doc``-th document; only the symbols that hold them are expanded."""
    symbols, rules, lengths, counts, base = _shard_arrays(shard)
    first = int(counts[:doc].sum())
    mine = symbols[first:first + int(counts[doc])].astype(np.int64)
    size = np.where(mine >= base, lengths[np.where(mine >= base, mine - base, 0)] if len(lengths) else 1, 1)
    upto = np.cumsum(size)
    start, stop = max(0, start), min(stop, int(upto[-1]) if len(upto) else 0)
    if start >= stop:
        return np.empty(0, np.uint32)
    a, b = np.searchsorted(upto, start, "right"), np.searchsorted(upto, stop, "left") + 1
    skipped = int(upto[a] - size[a])
    return expand(mine[a:b], rules, lengths, base)[start - skipped:stop - skipped]


def _shard_arrays(shard: dict):
    width = {2: "<u2", 4: "<u4"}[shard["width"]]
    return (np.frombuffer(shard["symbols"], width), np.frombuffer(shard["rules"], "<u4").reshape(-1, 2),
            np.frombuffer(shard["lengths"], "<u4"), np.asarray(shard["n_symbols"], np.int64), shard["base"])


# ------------------------------------------------------------------------------------------------ tables

_SHARD = ("part int, shard int, doc_ids array<{id}>, n_tokens array<bigint>, n_symbols array<bigint>, base int, "
          "rules binary, lengths binary, width int, symbols binary")


def _shard_row(part, shard, doc_ids, ids, n_tokens, base):
    symbols, n_symbols, rules, lengths = repair(ids, np.cumsum(n_tokens), base)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    return {"part": part, "shard": shard, "doc_ids": doc_ids, "n_tokens": n_tokens, "n_symbols": n_symbols, "base": base,
            "rules": rules.astype("<u4").tobytes(), "lengths": lengths.astype("<u4").tobytes(), "width": width,
            "symbols": symbols.astype(f"<u{width}").tobytes()}


def write_shards(docs: DataFrame, path: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` (doc_id, text) and write them as shards in ascending doc_id order to ``path``.

    Whole texts are encoded without special tokens; END_ID follows each document; null texts are empty. Null doc_ids come
    first; rows with one doc_id follow each other by a hash of their text and then the text. Other columns are ignored.
    An empty table gives an empty shard table. A shard closes at ``shard_tokens`` ids; one very long document may be a
    shard of its own. ``tokenizer`` is the path of a tokenizers file that exists on every machine.
    """
    prepare(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = _SHARD.format(id=kind)
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext
        part, shard, encoder = TaskContext.get().partitionId(), 0, None
        keys, ids, counts, held = [], [], [], 0

        def close():
            row = _shard_row(part, shard, keys, np.concatenate(ids), np.concatenate(counts), encoder.vocabulary)
            return pa.RecordBatch.from_pylist([row], schema=out)

        for batch in batches:
            encoder = _encoder(tokenizer)
            for piece in _slices(batch, SLICE_BYTES):
                got, n = encoder.encode(piece.column("text"))
                ends, at = np.cumsum(n), 0
                while at < len(n):                               # documents until the shard is full
                    before = int(ends[at - 1]) if at else 0
                    end = min(len(n), at + 1 + int(np.searchsorted(ends[at:], before + shard_tokens - held, "left")))
                    keys += piece.column("doc_id").slice(at, end - at).to_pylist()
                    ids.append(got[before:int(ends[end - 1])]), counts.append(n[at:end])
                    held, at = held + len(ids[-1]), end
                    if held >= shard_tokens:
                        yield close()
                        keys, ids, counts, held, shard = [], [], [], 0, shard + 1
        if keys:
            yield close()

    rows = docs.select("doc_id", "text")
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(releasing(run), schema).write.option("compression", "zstd").parquet(path)


def _slices(batch: pa.RecordBatch, most: int):
    """Parts of a batch of about ``most`` bytes of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def read_documents(spark, path: str) -> DataFrame:
    """Per document of a shard table, in the stored order: doc_id, start, n_tokens, ids_crc32 and stored symbols.

    ``start`` counts the ids of all documents before it: running sums within the shards, within the partitions and over
    the partitions, so no task sees more than one partition's shards or one row per partition.
    """
    from pyspark.sql import Window

    prepare(spark)
    shards = spark.read.parquet(path)
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"part int, shard int, doc_id {kind}, inside bigint, n_tokens bigint, ids_crc32 bigint, n_symbols bigint"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):                    # one shard at a time
                row = batch.slice(i, 1).to_pylist()[0]
                symbols, rules, lengths, n_symbols, base = _shard_arrays(row)
                ids = expand(symbols, rules, lengths, base).astype("<u4")
                n = np.asarray(row["n_tokens"], np.int64)
                stops = np.cumsum(n)
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * (b - k):4 * b]) for b, k in zip(stops.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip((np.full(len(n), row["part"], np.int32),
                                                     np.full(len(n), row["shard"], np.int32), row["doc_ids"],
                                                     stops - n, n, crc, n_symbols), out.types)], schema=out)

    docs = shards.mapInArrow(releasing(run), schema)
    per_shard = shards.select("part", "shard", F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)").alias("n"))
    per_part = per_shard.groupBy("part").agg(F.sum("n").alias("n"))
    parts = per_part.select("part", (F.sum("n").over(Window.partitionBy().orderBy("part")) - F.col("n")).alias("_a"))
    starts = (per_shard.join(parts, "part")
              .select("part", "shard", (F.col("_a") + F.sum("n").over(Window.partitionBy("part").orderBy("shard"))
                                        - F.col("n")).alias("_start")))
    return (docs.join(starts, ["part", "shard"])
            .select("doc_id", (F.col("_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "n_symbols"))


def store_tokens(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """`write_shards` to ``path`` (by default a fresh folder in the shared one), then `read_documents` from there."""
    spark = docs.sparkSession
    path = path or shared_path(spark, "shards")
    write_shards(docs, path, tokenizer)
    return read_documents(spark, path)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def query(spark, sf_dir):
    return store_tokens(table(spark, sf_dir, "documents"), default_tokenizer())
