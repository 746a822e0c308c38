"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

A is a byte-level BPE of the ``tokenizers`` library, B a ``sentencepiece`` model. A tells spans, the
characters a token covers. They are coarse cuts: a character of several bytes may be cut into several
tokens, which then all claim all of it. Where the spans do not say how many bytes a token has, its
decoded bytes do. B's pieces are their own surface, so its ids tell their spans (its protos hold the same ones
and take three times as long). The result is kept only if the decoded bytes of either side are those of the text.

Token ends in bytes decide the rest: tokens overlap if their byte ranges do, and offsets where
tokens of both sides end cut the text into groups.

No token of either side holds a space behind another character (``load`` looks it up), so a text may
be cut there beforehand: both tokenizers treat `` word`` alike wherever it stands, and a cut is the
end of a group. Arrow cuts the texts of a batch and numbers their words; each process remembers the alignment of
short words, and new ones of many texts are aligned together. A text with a word that either side cannot give back
is aligned whole. Rows are put together for the whole batch, from the words' numbers.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, pairwise, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmeter.llm.common import fresh
from lexmeter.operators.skew import join_salted
from lexmeter.sources.scratch import new_folder, written

FOLDER = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Id pairs up to which their counts are broadcast; more are joined by a shuffle.
LOOKUP = 2**20

#: Words of up to so many characters are remembered, and about twice so many of them in a process.
SHORT = 64
REMEMBERED = 2**17

_SPACE = "▁"
_BETWEEN = re.compile(r"(?<=\S) (?=.)", re.DOTALL)
#: Texts with a space that is no cut: the first or last character, or behind white space (all that Python takes for it).
_UNCUT = r"(?:\A|[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]) | \z"
_NEW = object()
#: Texts that are aligned together, and about how many bytes.
_BATCH = 1024
_BYTES = 2**20
#: Of an id in a pair; what they leave of 63 numbers the text of a batch.
_BITS = 24
#: Words that are encoded as one text, and at least.
_TOGETHER = 512
_FEWEST = 8
_ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, times array<int>"


class Parts:
    """Arrays, one after the other."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.values, self.sizes = values, sizes
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, parts: Sequence[bytes], kind: type = np.uint8) -> Parts:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return cls(np.frombuffer(b"".join(parts), kind), sizes // np.dtype(kind).itemsize)

    def joined(self, which: np.ndarray) -> np.ndarray:
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        place = np.repeat(self.starts[which] - ends + sizes, sizes)
        return self.values[place + np.arange(len(place))]


#: The alignment of a word with the space before it: numbers of A and B tokens and of groups, the groups as ASCII text,
#: and the id pairs as bytes, one for each link. Python's garbage collector passes over plain tuples of such values, while it
#: would go through hundreds of thousands of remembered objects of a class again and again.
Word = tuple[int, int, int, bytes, bytes]
_NOTHING: Word = (0, 0, 0, b"", b"")


class Memory:
    """Words used lately: since the last turn, or between the last two. A turn comes after ``size`` words."""

    def __init__(self, size: int = REMEMBERED, short: int = SHORT):
        self.size, self.short = size, short
        self.recent: dict[str, Word | None] = {}
        self.older: dict[str, Word | None] = {}

    def recall(self, words: list[str]) -> list[Word | None | object]:
        """What is known of each word, and ``_NEW`` of the others."""
        found = list(map(self.recent.get, words, repeat(_NEW)))
        for i, known in enumerate(found):
            if known is _NEW and (known := self.older.get(words[i], _NEW)) is not _NEW:
                found[i] = self.recent[words[i]] = known
        return found

    def keep(self, words: list[str], found: list[Word | None]) -> None:
        self.recent.update(pair for pair in zip(words, found, strict=True) if len(pair[0]) <= self.short)
        if len(self.recent) > self.size:
            self.recent, self.older = {}, self.recent


class Tokenizers(NamedTuple):
    """Both tokenizers of a process, the bytes of their tokens, and each id as text before either separator, A's first."""

    a: object
    b: object
    of_a: Parts
    of_b: Parts
    ids: Parts
    in_words: bool
    known: Memory


class Alignment(NamedTuple):
    """Token ids and end offsets in bytes; the groups' ends; and for each A token the B tokens it meets."""

    a: np.ndarray
    b: np.ndarray
    cuts: np.ndarray
    a_groups: np.ndarray
    b_groups: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def _byte_of_character() -> dict[str, int]:
    """The byte each printable stand-in of a byte-level vocabulary means."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in own]
    return {chr(byte): byte for byte in own} | {chr(256 + i): byte for i, byte in enumerate(rest)}


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[1:-1], 16)]) if is_byte else piece.replace(_SPACE, " ").encode()


@lru_cache(maxsize=1)
def load(folder: str, byte_bpe: str, pieces: str) -> Tokenizers:
    """Read the vocabulary files, once in each process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(f"{folder}/{byte_bpe}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{pieces}")
    meaning = _byte_of_character()
    a_bytes = [b""] * a.get_vocab_size(with_added_tokens=True)
    for token, number in a.get_vocab(with_added_tokens=True).items():
        # A special token stands for no text, so its strings never decode to one here.
        a_bytes[number] = bytes(meaning[c] for c in token) if all(c in meaning for c in token) else b""
    b_bytes = [_piece_bytes(b.id_to_piece(i), b.is_byte(i)) for i in range(b.get_piece_size())]
    across = re.compile(r"\S ")
    in_words = not any(across.search(token.decode(errors="replace")) for token in chain(a_bytes, b_bytes))
    sides = ((len(a_bytes), ",|"), (len(b_bytes), ",;"))
    ids = [f"{i}{end}".encode() for size, ends in sides for i in range(size) for end in ends]
    return Tokenizers(a, b, Parts.of(a_bytes), Parts.of(b_bytes), Parts.of(ids), in_words, Memory())


def _refined(coarse: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ends in bytes: those of the coarse spans, but for tokens whose spans are not their own.

    A span agrees with its token if it begins where the last one ended and is as long as the token's
    bytes. Runs of others, parts of one character or bytes of a fallback, are cut by
    their decoded bytes.
    """
    start, end = coarse
    sound = (start == np.append(0, end[:-1])) & (end - start == sizes[ids])
    if sound.all():
        return end
    return np.where(sound, end, np.cumsum(sizes[ids]))


def _a_ends(encodings: list, wholes: list[str], data: bytes, tokens: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ends of the tokens of some texts, one after the other."""
    ids = np.concatenate([np.array(e.ids, np.int64) for e in encodings])
    spans = np.concatenate([np.array(e.offsets, np.int64).reshape(-1, 2) for e in encodings])
    length = np.fromiter(map(len, wholes), np.int64, len(wholes))
    spans += np.repeat(np.cumsum(length) - length, list(map(len, encodings)))[:, None]
    if len(data) != length.sum():  # characters to bytes: before each character, and at the end
        heads = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
        place = np.append(np.flatnonzero(heads), len(data))
        spans = place[spans]
    return ids, _refined(spans.T, ids, tokens.of_a.sizes)


def _b_ends(pieces: list[np.ndarray], tokens: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    """The same for B, whose pieces are their surface. If its model changed the text, the bytes differ."""
    ids = np.concatenate(pieces).astype(np.int64)
    end = np.cumsum(tokens.of_b.sizes[ids])
    return ids, _refined(np.stack([np.append(0, end[:-1]), end]), ids, tokens.of_b.sizes)


def _linked(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of tokens whose byte ranges overlap."""
    a_start, b_start = (np.append(0, x[:-1]) for x in (a_end, b_end))
    first = np.searchsorted(b_end, a_start, "right")
    last = np.searchsorted(b_start, a_end, "left")
    number = np.maximum(last - first, 0)
    of_a = np.repeat(np.arange(len(a_end)), number)
    return of_a, np.arange(len(of_a)) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number)


def align(texts: list[str], encodings: list, pieces: list[np.ndarray], tokens: Tokenizers) -> Alignment | None:
    """The alignment of texts that follow each other; None if either side has other bytes than they."""
    wholes = [f" {text}" for text in texts]
    data = "".join(wholes).encode()
    a, a_end = _a_ends(encodings, wholes, data, tokens)
    b, b_end = _b_ends(pieces, tokens)
    wanted = np.frombuffer(data, np.uint8)
    if not all(np.array_equal(v.joined(ids), wanted) for ids, v in ((a, tokens.of_a), (b, tokens.of_b))):
        return None
    cuts = a_end[b_end[np.minimum(np.searchsorted(b_end, a_end), len(b_end) - 1)] == a_end]
    link_a, link_b = _linked(a_end, b_end)
    a_groups, b_groups = np.searchsorted(a_end, cuts, "right"), np.searchsorted(b_end, cuts, "right")
    return Alignment(a, b, cuts, a_groups, b_groups, link_a, link_b)


def _before(groups: np.ndarray, other: np.ndarray, inclusive: bool) -> np.ndarray:
    """For each token, the other side's tokens in the groups before its own, or up to it."""
    upto = np.append(0, other)
    own = np.repeat(np.arange(len(groups)), np.diff(groups, prepend=0))
    return upto[own + inclusive]


def _groups(found: Alignment, tokens: Tokenizers) -> np.ndarray:
    """Groups as ``a1,a2|b1;a3|b2,b3;``: the ids of either side in order, each with what follows it, as in ``Tokenizers``."""
    which = np.empty(len(found.a) + len(found.b), np.int64)
    for ids, own, other, first, later in (
        (found.a, found.a_groups, found.b_groups, 0, False),
        (found.b, found.b_groups, found.a_groups, 2 * len(tokens.of_a.sizes), True),
    ):
        last = np.zeros(len(ids), np.int64)
        last[own - 1] = 1
        which[np.arange(len(ids)) + _before(own, other, later)] = first + 2 * ids + last
    return which


def _encoded(texts: list[str], tokens: Tokenizers) -> tuple[list, list[np.ndarray]]:
    encodings = tokens.a.encode_batch([f" {text}" for text in texts], add_special_tokens=False)
    return encodings, tokens.b.encode(texts, return_type="numpy", num_threads=1)


def align_words(words: list[str], encodings: list, pieces: list[np.ndarray], tokens: Tokenizers) -> list[Word | None]:
    """The alignment of each word; None where either side has other bytes than it."""
    found = align(words, encodings, pieces, tokens)
    if found is None:  # at least one: look for it in both halves
        half = len(words) // 2
        halves = (slice(0, half), slice(half, None)) if half else ()
        return list(chain.from_iterable(align_words(words[h], encodings[h], pieces[h], tokens) for h in halves)) or [None]
    last = [np.cumsum([len(e) for e in encodings]), np.cumsum([len(p) for p in pieces])]
    group = np.searchsorted(found.a_groups, last[0], "right")
    return _words(found, last, group, tokens)


def _words(found: Alignment, last: list[np.ndarray], group: np.ndarray, tokens: Tokenizers) -> list[Word | None]:
    """The alignment of each word, given how many tokens of either side and groups there are up to its end."""
    link = np.append(0, 8 * np.searchsorted(found.link_a, last[0])).tolist()
    pairs = (found.a[found.link_a] << _BITS | found.b[found.link_b]).tobytes()
    which = _groups(found, tokens)
    groups = tokens.ids.joined(which).tobytes()
    text = np.append(0, np.cumsum(tokens.ids.sizes[which]))[np.append(0, last[0] + last[1])].tolist()
    counts = (np.diff(x, prepend=0).tolist() for x in (*last, group))
    texts = [groups[start : end - 1] for start, end in pairwise(text)]
    return list(zip(*counts, texts, [pairs[start:end] for start, end in pairwise(link)], strict=True))


def _joined(words: list[str], tokens: Tokenizers) -> list[Word | None]:
    """``align_words`` of words that are encoded together, as one text that would be cut into them.

    Each word is followed by a cut, so its tokens are its own; the ends of words are looked up
    among those of the tokens. Where one is missing, or bytes differ, it is looked for in both halves, and
    few words are encoded each for itself.
    """
    text = " ".join(words)
    found = align([text], *_encoded([text], tokens), tokens)
    ends = np.cumsum(pc.binary_length(pa.array(words, pa.large_string())).to_numpy() + 1)
    if found is None or not len(found.cuts) or not np.array_equal(
        found.cuts[np.minimum(np.searchsorted(found.cuts, ends), len(found.cuts) - 1)], ends
    ):
        half = len(words) // 2
        if half >= _FEWEST:
            return _joined(words[:half], tokens) + _joined(words[half:], tokens)
        return align_words(words, *_encoded(words, tokens), tokens)
    group = np.searchsorted(found.cuts, ends, "right")
    return _words(found, [found.a_groups[group - 1], found.b_groups[group - 1]], group, tokens)


def _aligned(words: list[str], tokens: Tokenizers) -> list[Word | None]:
    """The alignment of each new word. Words with a space at the end would join with the next one's."""
    alone = [word for word in words if not tokens.in_words or word[-1].isspace()]
    together = [word for word in words if not word[-1].isspace()] if alone else words
    if not tokens.in_words:
        together = []
    found = []
    for start in range(0, len(together), _TOGETHER):
        found += _joined(together[start : start + _TOGETHER], tokens)
    if not alone:
        return found
    known = dict(zip(together, found, strict=True))
    known.update(zip(alone, align_words(alone, *_encoded(alone, tokens), tokens), strict=True))
    return [known[word] for word in words]


class Rows(NamedTuple):
    """Counts and the digest of each text, and its distinct id pairs up to each end with how often each is linked."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    ends: np.ndarray
    a: np.ndarray
    b: np.ndarray
    times: np.ndarray


def _rows(found: list[Word], cut: list[np.ndarray]) -> Rows:
    """The rows of texts that are cut into the words of these numbers."""
    n_a, n_b, n_groups, groups, linked = zip(*found, _NOTHING, strict=True)
    words = np.concatenate([*cut, np.empty(0, np.int64)]).astype(np.int64)
    last = np.cumsum([0, *map(len, cut)])
    links = Parts.of(linked, np.int64)
    sums = [np.diff(np.append(0, np.cumsum(np.array(n)[words]))[last]) for n in (n_a, n_b, n_groups, links.sizes)]
    texts = [b";".join(map(groups.__getitem__, own.tolist())) for own in cut]
    digests = [hashlib.sha256(text).hexdigest() if text else "" for text in texts]
    pairs = np.sort(np.repeat(np.arange(len(cut)) << 2 * _BITS, sums[3]) | links.joined(words))
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])[: len(pairs)])
    times = np.diff(first, append=len(pairs))
    pairs = pairs[first]
    ends = np.searchsorted(pairs, np.arange(len(cut) + 1) << 2 * _BITS)
    a, b = pairs >> _BITS & (1 << _BITS) - 1, pairs & (1 << _BITS) - 1
    return Rows(*sums, digests, *(x.astype(np.int32) for x in (ends, a, b, times)))


def _each(rows: Rows) -> list[tuple]:
    """Each text's counts, digest, and id pairs."""
    lists = (np.split(x, rows.ends[1:-1]) for x in (rows.a, rows.b, rows.times))
    counts = (n.tolist() for n in rows[:4])
    return list(zip(*counts, rows.digests, *lists, strict=True))


def _cut(texts: list[str | None], in_words: bool) -> tuple[list[str], list[np.ndarray]]:
    """The distinct words of the texts, and their numbers in each text; none of a NULL or empty one."""
    filled = [text for text in texts if text]
    whole = pa.array(filled, pa.large_string())
    if in_words:
        parts = pc.split_pattern(whole, " ")
        uncut = pc.match_substring_regex(whole, _UNCUT).to_numpy(zero_copy_only=False)
        if uncut.any():
            again = pa.array([_BETWEEN.split(filled[i]) for i in np.flatnonzero(uncut)], parts.type)
            place = np.where(uncut, len(parts) + np.cumsum(uncut) - 1, np.arange(len(parts)))
            parts = pa.concat_arrays([parts, again]).take(pa.array(place))
        whole, sizes = parts.flatten(), parts.value_lengths().to_numpy()
    else:
        sizes = np.ones(len(filled), np.int64)
    numbered = whole.dictionary_encode()
    each = iter(np.split(numbered.indices.to_numpy(), np.cumsum(sizes)[:-1]))
    none = np.empty(0, np.int64)
    words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist takes ten times as long
    return words, [next(each) if text else none for text in texts]


def _row(found: list[Word | None]) -> tuple:
    """The row of a text of these words. A text with None has nothing."""
    return _each(_rows([known or _NOTHING for known in found], [np.arange(len(found))]))[0]


def aligned_rows(texts: list[str | None], tokens: Tokenizers) -> Rows:
    """Counts, digest and id pairs of some texts."""
    words, cut = _cut(texts, tokens.in_words)
    found = tokens.known.recall(words)
    at = [i for i, known in enumerate(found) if known is _NEW]
    new = [words[i] for i in at]
    aligned = _aligned(new, tokens)
    tokens.known.keep(new, aligned)
    for i, known in zip(at, aligned, strict=True):
        found[i] = known
    if None in found:
        lost = np.array([known is None for known in found])
        for i, own in enumerate(cut):
            if len(own) > 1 and lost[own].any():
                cut[i] = np.array([len(found)])
                found += align_words([texts[i]], *_encoded([texts[i]], tokens), tokens)
        found = [known or _NOTHING for known in found]
    return _rows(found, cut)


def alignments(texts: list[str | None], tokens: Tokenizers) -> list[tuple]:
    """The same, text by text."""
    return _each(aligned_rows(texts, tokens))


def _slices(texts: pa.Array) -> list[int]:
    """Where to cut a batch, for what a slice takes in memory grows with its texts."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    full = np.diff(np.cumsum(sizes, dtype=np.int64) // _BYTES, prepend=0)
    return sorted({0, *np.flatnonzero(full).tolist(), *range(0, len(texts), _BATCH), len(texts)})


def _aligner(folder: str, byte_bpe: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = load(folder, byte_bpe, pieces)
        for batch in batches:
            for start, end in pairwise(_slices(batch.column("text"))):
                part = batch.slice(start, end - start)
                rows = aligned_rows(part.column("text").to_pylist(), tokens)
                columns = {"id": part.column("id"), "row": part.column("row")}
                columns |= {n: pa.array(getattr(rows, n), pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")}
                columns["groups_sha256"] = pa.array(rows.digests, pa.string())
                columns |= {n: pa.ListArray.from_arrays(rows.ends, getattr(rows, n)) for n in ("a", "b", "times")}
                yield pa.record_batch(columns)

    return run


def _pair(link: str) -> Column:
    return F.shiftleft(F.col(f"{link}.a").cast("long"), 32).bitwiseOR(F.col(f"{link}.b").cast("long"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, and the documents that hold it linked."""
    each = aligned.select(F.explode(F.arrays_zip("a", "b")).alias("link"))
    return each.groupBy(_pair("link").alias("pair")).agg(F.count(F.lit(1)).alias("docs"))


def best_pairs(counts: DataFrame) -> DataFrame:
    """The counts, and whether no pair of the same A id has a higher one."""
    named = counts.withColumn("a_id", F.shiftright("pair", 32))
    highest = named.groupBy("a_id").agg(F.max("docs").alias("most"))
    best = (F.col("docs") == F.col("most")).alias("best")
    return named.join(highest, "a_id").select("pair", "docs", best)


def align_tokens(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    folder: str = FOLDER,
    byte_bpe: str = BYTE_BPE,
    pieces: str = PIECES,
    lookup: int = LOOKUP,
) -> DataFrame:
    """Id, token, group and link counts of every text, and how common its links are.

    ``n_best`` counts the links whose id pair is linked in as many documents as any pair of its A id,
    and ``count_sum`` adds up those documents over the links. A NULL or empty text, and one that
    either tokenizer cannot give back byte by byte, has zeros and the digest ''. Repeated rows
    stay, each a document of its own; a NULL id is kept as it is.
    """
    spark = docs.sparkSession
    scratch = new_folder(spark)
    named = docs.select(
        F.col(id).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text")
    )
    kind = dict(named.dtypes)["id"]
    run = _aligner(folder, byte_bpe, pieces)
    aligned = written(named.mapInArrow(run, f"id {kind}, row long, {_ALIGNED}"), f"{scratch}/aligned")
    counts = written(pair_counts(aligned), f"{scratch}/counts")
    rated = written(best_pairs(counts), f"{scratch}/rated")
    links = aligned.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("link"))
    links = links.select("row", _pair("link").alias("pair"), F.col("link.times").cast("long").alias("times"))
    if rated.count() <= lookup:
        joined = links.join(F.broadcast(rated), "pair")
    else:  # a pair is held by as many rows as documents, so its count is its weight
        joined = join_salted(links, rated, "pair", "docs", F.col("row"))
    sums = joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("docs") * F.col("times")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    totals = [F.coalesce(n, zero).alias(n) for n in ("n_best", "count_sum")]
    counted = ["n_a", "n_b", "n_groups", "n_links"]
    own = F.col("id").alias(fresh([*counted, "n_best", "count_sum", "groups_sha256"], id))
    return aligned.join(sums, "row", "left").select(own, *counted, *totals, "groups_sha256")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the two tokenizers over all documents."""
    return align_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
