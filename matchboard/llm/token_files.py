"""Token id files compressed by a grammar (Re-Pair).

Documents are encoded, dealt in ascending id order, and written as shard files of bounded size. In each shard
frequent pairs of neighbouring ids are replaced by new symbols, round after round until none is frequent enough. A
round takes many pairs at once; where their places overlap, the more frequent pair goes first, and a pair of equal
symbols takes every second place of a run. No pair reaches over the end of a document.

A shard file holds the rules, how many ids each rule stands for, where each document's symbols begin, and the
symbols. One document is decoded from its own symbols and the rules alone; the expansion lengths tell which
symbols cover a given range of its ids.

Words are what a shard has most of its repetition in, so pairs within words are counted and replaced in every
different word once, by how often it occurs, and pairs over the ends of words after that.

Encoding uses the tokenizers library on the byte-level words that the vocabulary's own pattern cuts, and
remembers the ids of words seen in a task; the result is that of the library on the whole text. With
``added_tokens``, texts that hold a string of one of the tokenizer's added tokens are encoded by the library
itself, which gives that token's id; otherwise such strings are ordinary text, as with the library's
``encode_special_tokens``.

Null texts count as empty: they have the end id alone. Null ids come first; repeated rows are written as often
as given. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

import re
import struct
import sys
import unicodedata
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchboard.cluster import new_folder
from matchboard.llm.common import stored, text_of
from matchboard.llm.files import create, new_name, read_all

TOKENIZER = "byte_bpe_50k.json"
END = 0
SHARD_WORDS = 1 << 20  # a shard ends with the document that reaches this; some two ids a word
RULES_A_ROUND = 16_384  # others wait for the next round
GONE = np.uint32(0xFFFFFFFF)  # no symbol: the second one of a replaced pair
LEAST_COUNT = 6  # a rule takes three numbers, each replaced pair saves one
SHARDS_AT_ONCE = 4  # whose words are looked up together
KEEP_WORDS = 800_000  # words that a task remembers
WORDS_A_CHUNK = 1 << 16
LONG_WORD = 64
MAGIC = b"REPAIR1\0"

# Fixed value: white space as the tokenizer's pattern knows it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


ASTRAL = re.compile("[\U00010000-\U0010ffff]")


@lru_cache(maxsize=2)
def _pattern(top: int) -> re.Pattern:
    """The vocabulary's word pattern, with its Unicode classes spelled out up to the code point ``top``.

    Texts without higher characters are cut alike by a pattern that stops there, and much faster.
    """

    def ranges(kind: str) -> str:
        out, start, last = [], None, None
        for code in range(top + 2):
            if code <= top and unicodedata.category(chr(code))[0] == kind:
                start, last = (code, code) if start is None else (start, code)
            elif start is not None:
                out.append(f"\\U{start:08x}-\\U{last:08x}")
                start = None
        return "".join(out)

    letters, numbers = ranges("L"), ranges("N")
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACE}{letters}{numbers}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
    )


def words_of(text: str) -> list[str]:
    return _pattern(sys.maxunicode if ASTRAL.search(text) else 0xFFFF).findall(text)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of so many elements from each start on, one span after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Encoder:
    """Numbers of words; the ids of a word are ``sizes[number]`` ones in ``flat``. New words are encoded by the library's model.

    An id that stands alone is a word, too: a line feed and its digits, which the pattern never cuts from a text.
    """

    def __init__(self, tokenizer_file: str, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.letters = _byte_letters()
        self.n_plain = self.tokenizer.get_vocab_size()
        self.known = pa.array([], pa.large_string())
        self.flat = np.empty(0, dtype=np.uint16 if self.n_plain <= 1 << 16 else np.uint32)
        self.sizes = np.empty(0, dtype=np.int64)
        self.last_met = np.empty(0, dtype=np.int64)
        self.turn = 0

    def words(self, text: str) -> list[str]:
        """The words of a text and of the end of its document."""
        if any(t in text for t in self.added):
            return [f"\n{i}" for i in (*self.tokenizer.encode(text, add_special_tokens=False).ids, END)]
        words = words_of(text)
        words.append(f"\n{END}")
        return words

    def _learn(self, words: pa.Array) -> None:
        """Append the ids of new words."""
        names = words.to_numpy(zero_copy_only=False).tolist()
        letters = "".join(names).encode().decode("latin-1").translate(self.letters)  # one for each byte
        ends = np.cumsum(pc.binary_length(words).to_numpy())
        ids, sizes, start, tokenize = array(self.flat.dtype.char), array("q"), 0, self.model.tokenize
        for name, end in zip(names, ends.tolist()):
            found = [int(name)] if name[0] == "\n" and name[1:].isdigit() else [t.id for t in tokenize(letters[start:end])]
            ids.extend(found)
            sizes.append(len(found))
            start = end
        self.flat = np.append(self.flat, np.array(ids))
        self.sizes = np.append(self.sizes, np.array(sizes))
        self.last_met = np.append(self.last_met, np.zeros(len(sizes), dtype=np.int64))

    def numbers(self, shards: list[pa.DictionaryArray]) -> list[np.ndarray]:
        """The number of each word, good until the next call. Known words come first, so they keep their numbers."""
        self._forget()
        n_known = len(self.known)
        coded = pa.chunked_array([self.known, *(s.dictionary for s in shards)]).combine_chunks().dictionary_encode()
        self.known = coded.dictionary
        self._learn(self.known.slice(n_known))
        number = coded.indices.to_numpy()[n_known:]
        self.turn += 1
        self.last_met[number] = self.turn
        upto = np.cumsum([len(s.dictionary) for s in shards])
        return [own[s.indices.to_numpy()] for own, s in zip(np.split(number, upto[:-1]), shards)]

    def _forget(self) -> None:
        """Forget the words that were not met for the longest time, if there are too many, and long ones."""
        kept = np.flatnonzero(pc.utf8_length(self.known).to_numpy() <= LONG_WORD)
        if len(kept) > KEEP_WORDS:
            kept = np.sort(kept[np.argsort(-self.last_met[kept], kind="stable")[: KEEP_WORDS * 2 // 3]])
        if len(kept) < len(self.known):
            self.flat = self.flat[_spans(_starts(self.sizes)[kept], self.sizes[kept])]
            self.known, self.sizes, self.last_met = self.known.take(pa.array(kept)), self.sizes[kept], self.last_met[kept]


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str, added_tokens: bool = False) -> Encoder:
    return Encoder(tokenizer_file, added_tokens)


@dataclass
class Grammar:
    """``n_plain`` ids, then one symbol per rule; ``ends`` are where each document's symbols end."""

    n_plain: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray
    ends: np.ndarray
    table: tuple | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of every symbol, one after the other, and where they start and how many they are."""
        if self.table is None:
            sizes = np.concatenate((np.ones(self.n_plain, dtype=np.int64), self.lengths))
            starts = _starts(sizes)
            flat = np.empty(int(sizes.sum()), dtype=np.uint32)
            flat[: self.n_plain] = np.arange(self.n_plain)
            parts = np.column_stack((self.left, self.right))
            highest = np.maximum.accumulate(parts.max(axis=1))
            first = 0
            while first < len(parts):  # at once all rules up to the first one with a part among them
                end = int(np.searchsorted(highest, self.n_plain + first))
                asked = parts[first:end].ravel()
                at = starts[self.n_plain + first]
                flat[at : at + sizes[asked].sum()] = flat[_spans(starts[asked], sizes[asked])]
                first = end
            self.table = flat, starts, sizes
        return self.table

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        flat, starts, sizes = self._expansions()
        return flat[_spans(starts[symbols], sizes[symbols])]

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        plain = symbols < self.n_plain
        return np.where(plain, 1, self.lengths[np.where(plain, 0, symbols.astype(np.int64) - self.n_plain)] if len(self.lengths) else 1)

    def document(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start to stop of the i-th document; only symbols that cover them are expanded."""
        symbols = self.symbols[self.ends[i - 1] if i else 0 : self.ends[i]]
        upto = np.cumsum(self.sizes(symbols))
        stop = int(upto[-1]) if stop is None and len(upto) else (stop or 0)
        first = int(np.searchsorted(upto, start, side="right"))
        last = int(np.searchsorted(upto, stop, side="left")) + 1
        skip = start - (int(upto[first - 1]) if first else 0)
        return self.expand(symbols[first:last])[skip : skip + max(0, stop - start)]


def _without_overlap(at: np.ndarray, rank: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Which of the ascending places of pairs to replace: a place goes before its neighbours if its pair is the more
    frequent one, and every second place of a run of equal symbols. Repeated for places whose neighbours are out."""
    beside = after[at[:-1]] == at[1:]
    taken = np.ones(len(at), dtype=bool)
    taken[1:] &= ~beside
    taken[:-1] &= ~beside
    left = np.flatnonzero(~taken)
    while len(left):
        places, ranks = at[left], rank[left]
        beside = after[places[:-1]] == places[1:]
        first, then = ranks[:-1], ranks[1:]
        best = ~np.append(False, beside & (first < then))
        best[:-1] &= ~(beside & (then < first))
        same = np.append(False, beside & (then == first) & best[:-1])  # one more of a run of equal symbols
        if same.any():
            number = np.arange(len(left))
            best &= (number - np.maximum.accumulate(np.where(same, 0, number))) % 2 == 0
        taken[left[best]] = True
        out = best.copy()
        out[1:] |= beside & best[:-1]
        out[:-1] |= beside & best[1:]
        left = left[~out]
    return taken


def _by_pair(left: np.ndarray, right: np.ndarray, places: np.ndarray, n_symbols: int, n_places: int) -> tuple[np.ndarray, np.ndarray]:
    """Where in the sorted order each different pair starts, and the places in the order of their pairs, then ascending."""
    bits, place_bits = n_symbols.bit_length(), n_places.bit_length()
    if 2 * bits + place_bits <= 64:  # pair and place are sorted as one number, several times as fast
        code = left.astype(np.uint64)
        code <<= np.uint64(bits)
        code |= right
        code <<= np.uint64(place_bits)
        code |= places.view(np.uint64)
        code.sort()
        places = (code & np.uint64((1 << place_bits) - 1)).view(places.dtype)
        code >>= np.uint64(place_bits)
    else:
        code = left.astype(np.uint64) << np.uint64(32) | right
        order = np.lexsort((places, code))
        code, places = code[order], places[order]
    return np.flatnonzero(np.append(True, code[1:] != code[:-1]) if len(code) else []), places


class _Pool:
    """Frequent pairs: their symbols, counts and places; ``group`` is the number of each place's pair."""

    def __init__(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray, places: np.ndarray, group: np.ndarray):
        self.left, self.right, self.counts, self.places, self.group = left, right, counts, places, group

    def only(self, pairs: np.ndarray) -> _Pool:
        kept = pairs[self.group]
        return _Pool(self.left[pairs], self.right[pairs], self.counts[pairs], self.places[kept], (np.cumsum(pairs) - 1)[self.group[kept]])

    def __add__(self, more: _Pool) -> _Pool:
        both = [(getattr(self, x), getattr(more, x)) for x in ("left", "right", "counts", "places")]
        return _Pool(*map(np.concatenate, both), np.concatenate((self.group, more.group + len(self.left))))


class _Rules:
    """Rules made so far, the number of ids each symbol stands for, and the rounds that make more of them."""

    def __init__(self, n_plain: int):
        self.left, self.right, self.sizes = [], [], np.ones(n_plain, dtype=np.int64)

    def replace(self, symbols: np.ndarray, inner: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Replace frequent pairs until no pair is left that is frequent enough; a pair begins where ``inner`` is set.

        Symbols keep their places, and each place knows the next and the one before, so a round touches no more than
        the places of its pairs. All pairs are counted once. After that only pairs with a new symbol can become
        frequent, and these stand beside it; others only lose places, which is seen when they are replaced. A pair
        that gave way to others is counted again by the places it still has. With ``weight``, every symbol stands
        for so many.
        """
        n = len(symbols)
        symbols = np.append(symbols, GONE)  # the last one stands behind the end of every part
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[:-1][~inner] = n
        before[0] = before[1:][~inner] = n
        mark, rule_at = np.zeros(n + 1, dtype=bool), np.empty(n + 1, dtype=np.int32)

        def frequent(places: np.ndarray) -> _Pool:
            starts, places = _by_pair(symbols[places], symbols[after[places]], places, len(self.sizes), n)
            sizes = np.diff(np.append(starts, len(places)))
            counts = sizes if weight is None or not len(starts) else np.add.reduceat(weight[places], starts)
            often = counts >= LEAST_COUNT
            first = places[starts[often]]
            group = np.repeat(np.arange(len(first), dtype=np.int32), sizes[often])
            pool = _Pool(symbols[first], symbols[after[first]], counts[often], places[np.repeat(often, sizes)], group)
            equal = pool.left == pool.right
            if equal.any():  # every second place of a run counts
                places = np.flatnonzero(equal[group])
                out = places[~_without_overlap(pool.places[places], np.zeros(len(places), dtype=np.int32), after)]
                less = np.bincount(group[out], None if weight is None else weight[pool.places[out]], minlength=len(first))
                pool.counts = pool.counts - less.astype(np.int64)
                pool = pool.only(pool.counts >= LEAST_COUNT)
            return pool

        pool, stale = frequent(np.flatnonzero(inner)), False
        while len(pool.left):
            best = np.lexsort((pool.right, pool.left, -pool.counts))[:RULES_A_ROUND]
            a, b = pool.left[best], pool.right[best]
            rank = np.full(len(pool.left), -1, dtype=np.int32)
            rank[best] = np.arange(len(best))
            rule = rank[pool.group]
            at = pool.places
            if len(best) < len(rank):
                at, rule = at[rule >= 0], rule[rule >= 0]

            def there(at: np.ndarray, rule: np.ndarray) -> np.ndarray:
                return (symbols[at] == a[rule]) & (symbols[after[at]] == b[rule])

            if stale:  # places that earlier rounds took from pairs which had to wait
                still = there(at, rule)
                at, rule = at[still], rule[still]
            stale = len(best) < len(rank)
            rule_at[at] = rule
            mark[at] = True
            at = np.flatnonzero(mark)
            mark[at] = False
            rule = rule_at[at]
            take = _without_overlap(at, rule, after)
            run = np.zeros(len(at), dtype=np.int64)  # places side by side, which alone can be in each other's way
            run[1:] = np.cumsum(after[at[:-1]] != at[1:])
            given = np.ones(len(at), dtype=bool)
            while True:  # a pair that is left with too few places leaves them to others
                made = np.bincount(rule[take], None if weight is None else weight[at[take]], minlength=len(a)) >= LEAST_COUNT
                lost = np.flatnonzero(given & ~made[rule])
                if not len(lost):
                    break
                given[lost] = take[lost] = False
                changed = np.zeros(len(at), dtype=bool)
                changed[run[lost]] = True
                again = np.flatnonzero(changed[run] & given)
                take[again] = _without_overlap(at[again], rule[again], after)
            unmade, unmade_rule = at[~given], rule[~given]
            at, rule = at[take], rule[take]
            self.left.append(a[made].astype(np.int64))
            self.right.append(b[made].astype(np.int64))
            number = (len(self.sizes) + np.cumsum(made) - 1).astype(np.uint32)
            self.sizes = np.concatenate((self.sizes, self.sizes[a[made]] + self.sizes[b[made]]))
            second = after[at]
            third = after[second]
            symbols[at] = number[rule]
            symbols[second] = GONE
            after[at] = third
            before[third] = at
            mark[at] = True
            earlier = before[at]
            earlier = earlier[(earlier < n) & ~mark[earlier]]
            mark[at] = False
            gave_way = unmade[there(unmade, unmade_rule)]
            pool = pool.only(rank < 0) + frequent(np.concatenate((at[third < n], earlier, gave_way)))
        kept = symbols[:-1] != GONE
        return symbols[:-1][kept], after[:-1][kept] < n

    def grammar(self, n_plain: int, symbols: np.ndarray, ends: np.ndarray) -> Grammar:
        none = np.empty(0, dtype=np.int64)
        return Grammar(n_plain, np.concatenate(self.left or [none]), np.concatenate(self.right or [none]), self.sizes[n_plain:], symbols, ends)


def _inner(size: int, ends: np.ndarray) -> np.ndarray:
    """Set but at the last place of each part."""
    inner = np.ones(size, dtype=bool)
    inner[ends - 1] = False
    return inner


def compress(ids: np.ndarray, ends: np.ndarray, n_plain: int) -> Grammar:
    """The grammar of documents with at least one id each, that end at ``ends``."""
    rules = _Rules(n_plain)
    symbols, inner = rules.replace(ids.astype(np.uint32), _inner(len(ids), ends))
    return rules.grammar(n_plain, symbols, np.flatnonzero(~inner) + 1)


def compress_words(numbers: np.ndarray, ends: np.ndarray, pieces: list[bytes], kind: np.dtype, n_plain: int) -> Grammar:
    """The same for documents of words, given by number: at least one each, and none without ids.

    Pairs within words are replaced first, in every different word once, by how often the word occurs. Then the words
    take their places, and pairs go on being replaced over all.
    """
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // kind.itemsize
    return compress_flat_words(numbers, ends, np.frombuffer(b"".join(pieces), dtype=kind), sizes, n_plain)


def compress_flat_words(numbers: np.ndarray, ends: np.ndarray, flat: np.ndarray, sizes: np.ndarray, n_plain: int) -> Grammar:
    """The same with the ids of all words one after the other, so many of each."""
    counts = np.bincount(numbers, minlength=len(sizes))
    used = np.flatnonzero(counts)
    lengths = sizes[used]
    ids = flat[_spans(_starts(sizes)[used], lengths)].astype(np.uint32)
    rules = _Rules(n_plain)
    parts, inner = rules.replace(ids, _inner(len(ids), np.cumsum(lengths)), np.repeat(counts[used], lengths))
    part_ends = np.flatnonzero(~inner) + 1
    place = np.zeros(len(sizes), dtype=np.int64)
    place[used] = np.arange(len(used))
    size = np.diff(part_ends, prepend=0)
    word = place[numbers]
    symbols = parts[_spans((part_ends - size)[word], size[word])]
    symbols, inner = rules.replace(symbols, _inner(len(symbols), np.cumsum(size[word])[ends - 1]))
    return rules.grammar(n_plain, symbols, np.flatnonzero(~inner) + 1)


def to_bytes(g: Grammar, doc_ids: list[int | None]) -> bytes:
    head = struct.pack("<8sIIQQ", MAGIC, g.n_plain, len(g.left), len(doc_ids), len(g.symbols))
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8")
    parts = [g.left.astype("<u4"), g.right.astype("<u4"), g.lengths.astype("<u4"), ids, known, g.ends.astype("<u8"), g.symbols.astype("<u4")]
    return head + b"".join(p.tobytes() for p in parts)


def from_bytes(data: bytes) -> tuple[Grammar, list[int | None]]:
    magic, n_plain, n_rules, n_docs, n_symbols = struct.unpack_from("<8sIIQQ", data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at, out = struct.calcsize("<8sIIQQ"), []
    for kind, n in (("<u4", n_rules), ("<u4", n_rules), ("<u4", n_rules), ("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs), ("<u4", n_symbols)):
        out.append(np.frombuffer(data, dtype=kind, count=n, offset=at))
        at += out[-1].nbytes
    left, right, lengths, ids, known, ends, symbols = out
    doc_ids = [i if k else None for i, k in zip(ids.tolist(), known.tolist())]
    return Grammar(n_plain, left.astype(np.int64), right.astype(np.int64), lengths.astype(np.int64), symbols, ends.astype(np.int64)), doc_ids


def write_shards(
    docs: DataFrame, tokenizer_file: str | None = None, id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False
) -> DataFrame:
    """Write all documents; rows (file, start, n_docs, n_tokens, file_bytes) per shard, start being the ids before it."""
    tokenizer = tokenizer_file or public_tokenizers.path(TOKENIZER)
    folder = new_folder(docs.sparkSession, "token-files")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))

    def write(batches):
        encode, part, n_files = encoder(tokenizer, added_tokens), TaskContext.get().partitionId(), 0
        n_plain = encode.n_plain
        doc_ids, ends, held, words, shards = [], [], [], [], []

        def hold():
            held.append(pa.array(words, pa.large_string()))
            words.clear()

        def end_shard():
            hold()
            shards.append((doc_ids[:], np.array(ends), pa.chunked_array(held).combine_chunks().dictionary_encode()))
            for part_of_it in (doc_ids, ends, held):
                part_of_it.clear()

        def flush():
            nonlocal n_files
            for (names, upto, _), numbers in zip(shards, encode.numbers([coded for *_, coded in shards])):
                grammar = compress_flat_words(numbers, upto, encode.flat, encode.sizes, n_plain)
                data = to_bytes(grammar, names)
                name = new_name(folder, "shard", ".ids")
                with create(name) as file:
                    file.write(data)
                row = (part, n_files, name, len(names), int(grammar.sizes(grammar.symbols).sum()), len(data))
                n_files += 1
                yield pa.record_batch([pa.array([v]) for v in row], ["part", "place", "file", "n_docs", "n_tokens", "file_bytes"])
            shards.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                more = encode.words(text.as_py())
                words += more
                ends.append((ends[-1] if ends else 0) + len(more))
                if len(words) >= WORDS_A_CHUNK:
                    hold()
                if ends[-1] >= SHARD_WORDS:
                    end_shard()
                if len(shards) == SHARDS_AT_ONCE:
                    yield from flush()
        if doc_ids:
            end_shard()
        if shards:
            yield from flush()

    order = ("doc_id", F.xxhash64("text"))  # rows of one id, or of none, are spread by their texts
    in_order = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "part long, place long, file string, n_docs long, n_tokens long, file_bytes long"
    files = stored(in_order.mapInArrow(write, schema), "token-shards")
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per partition
    before = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = F.coalesce(F.sum("n_tokens").over(W.partitionBy("part").orderBy("place").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("own", own).join(before, "part").select("file", (F.col("before") + F.col("own")).alias("start"), "n_docs", "n_tokens", "file_bytes")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_shards(shards: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32), every document decoded from its shard file."""

    def read(batches):
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                grammar, doc_ids = from_bytes(read_all(file))
                lengths = np.add.reduceat(grammar.sizes(grammar.symbols), np.concatenate(([0], grammar.ends[:-1])))
                ends = np.cumsum(lengths)
                data = grammar.expand(grammar.symbols).astype("<u4", copy=False)
                sums = [zlib.crc32(data[e - n : e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist())]
                starts = start + ends - lengths
                columns = [pa.array(doc_ids, pa.int64()), pa.array(starts.astype(np.int64)), pa.array(lengths.astype(np.int64)), pa.array(sums, pa.int64())]
                yield pa.record_batch(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # shards are of a size; deal them evenly
    return shards.select("file", "start").repartition(tasks).mapInArrow(read, DOCUMENTS)
