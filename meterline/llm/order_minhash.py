"""Fingerprints of documents by Order MinHash, in DataFrame and SQL functions only.

A text is the list of its k-mers: windows of `k` code points, numbered by occurrence, so the second time that a
k-mer is met it is an element of its own. The elements' hashes are dealt over `bins` by their first bits, which makes each bin a random
permutation of its share of elements. A bin selects its `order` minimal elements, puts them back into the order of the text and hashes that tuple.
Two texts agree in a bin if they share its minimal elements in the same order, so the share of equal bins
falls with edits and with moved passages alike. The likeness is the `order`-th root of that share, as
a bin needs that many elements to agree at once.

An element travels as one long: the first 33 bits of its hash, then the 31 bits of its byte position in UTF-32. Two
k-mers of a text whose 33 bits are equal count as one k-mer. All steps are linear in the text but for two sorts of longs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HASH = "-2147483648L"  # the bits of an element that hold its hash


@dataclass(frozen=True)
class OrderMinHash:
    """`k` code points a k-mer, `order` elements a tuple, two to the power of `bin_bits` tuples a text."""

    k: int = 8
    order: int = 2
    bin_bits: int = 6


def add_fingerprint(df: DataFrame, text: str, out: str, how: OrderMinHash = OrderMinHash()) -> DataFrame:
    """The frame and a column `out`: an ascending array of longs, for each bin with elements its number and 32 bits of its tuple's hash.

    A null or empty text has an empty array. A text shorter than `k` is one k-mer. Equal texts have equal arrays. The names
    `_omh_…` are taken; all other columns stay.
    """
    size, first = 4 * how.k, 64 - how.bin_bits
    places = f"sequence(1, 4 * greatest(length(v) div 4 - {how.k}, 0) + 1, 4)"
    element = f"(xxhash64(substring(v, p, {size})) & {_HASH}) | p"
    # A lambda's variable keeps the bytes as they are; a column would be copied out of its row for each k-mer.
    listed = f"transform(array(encode(coalesce(`{text}`, ''), 'UTF-32')), v -> transform({places}, p -> {element}))[0]"
    step = df.select("*", F.expr(f"sort_array({listed})").alias("_omh_all"))
    # Equal k-mers are neighbours in the order of the text. The first of each run is set aside; the lengths of what is left
    # of the runs give the occurrence numbers.
    again = "filter(_omh_all, (x, i) -> i > 0 and ((_omh_all[i - 1] ^ x) & {0}) = 0)".format(_HASH)
    step = step.select("*", F.expr(again).alias("_omh_again"))
    starts = "transform(_omh_again, (x, i) -> if(i = 0 or ((_omh_again[i - 1] ^ x) & {0}) != 0, i, -1))".format(_HASH)
    step = step.select("*", F.expr(f"array_remove({starts}, -1)").alias("_omh_runs"))
    ends = "coalesce(try_element_at(_omh_runs, q + 2), size(_omh_again))"
    numbers = f"flatten(transform(_omh_runs, (r, q) -> sequence(2, {ends} - r + 1)))"
    numbered = "coalesce((xxhash64(x & {0}, n) & {0}) | (x & 2147483647L), 0L)".format(_HASH)
    step = step.select(
        "*",
        F.expr("array_except(_omh_all, _omh_again)").alias("_omh_once"),
        F.expr(f"sort_array(zip_with(_omh_again, {numbers}, (x, n) -> {numbered}))").alias("_omh_more"),
    )

    def least(of: str) -> str:
        apart = f"shiftrightunsigned({of}[i - {how.order}] ^ x, {first}) != 0"
        return f"filter({of}, (x, i) -> i < {how.order} or {apart})"

    # Where each bin of the longer list begins is found by halving steps, so not every element is looked at.
    steps = "transform(sequence(length(bin(size(_omh_once))) - 1, 0, -1), s -> shiftleft(1, s))"
    step = step.select("_omh_more", "_omh_once", F.expr(steps).alias("_omh_steps"), *[F.col(f"`{c}`") for c in df.columns if c != out])
    begin = f"aggregate(_omh_steps, 0, (c, s) -> if(get(w, c + s - 1) < shiftleft(cast(b as bigint), {first}), c + s, c))"
    heads = ", ".join(f"get(w, c + {i})" for i in range(how.order))
    own = f"filter(transform(array({begin}), c -> array({heads}))[0], y -> shiftrightunsigned(y, {first}) = b)"
    bins = f"flatten(transform(sequence(0, {2**how.bin_bits - 1}), b -> {own}))"
    once = f"array_compact(transform(array(_omh_once), w -> {bins})[0])"
    # The least elements of a bin are among the least of either list.
    few = f"sort_array(concat({once}, {least('_omh_more')}))"
    step = step.select("*", F.expr(few).alias("_omh_few"))
    step = step.select("*", F.expr(least("_omh_few")).alias("_omh_least"))
    # The first element of each bin takes the bin's others along; position ahead of hash puts them in the order of the text.
    same = f"filter(slice(_omh_least, i + 1, {how.order}), y -> shiftrightunsigned(y ^ x, {first}) = 0)"
    placed = f"sort_array(transform({same}, y -> shiftleft(y, 33) | shiftrightunsigned(y, 31)))"
    tuple_hash = f"xxhash64(transform({placed}, y -> y & 8589934591L)) & 4294967295L"
    named = f"shiftleft(shiftrightunsigned(x, {first}), 32) | ({tuple_hash})"
    leads = f"i = 0 or shiftrightunsigned(_omh_least[i - 1] ^ x, {first}) != 0"
    signed = f"sort_array(array_remove(transform(_omh_least, (x, i) -> if({leads}, {named}, -1L)), -1L))"
    signed = f"if(coalesce(`{text}`, '') = '', cast(array() as array<bigint>), {signed})"
    return step.select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.expr(signed).alias(out))


def likeness(a: str, b: str, how: OrderMinHash = OrderMinHash()) -> Column:
    """Likeness of two fingerprints, 0 to 1: of the bins that either has, the share that agrees, to the power of 1 / `order`.

    Two empty texts are alike (1); an empty one is like no other (0).
    """
    bins = [f"transform(`{c}`, s -> shiftright(s, 32))" for c in (a, b)]
    either = f"size(array_union({bins[0]}, {bins[1]}))"
    share = f"size(array_intersect(`{a}`, `{b}`)) / {either}"
    return F.expr(f"if(size(`{a}`) + size(`{b}`) = 0, 1D, power({share}, {1 / how.order}D))")


def as_text(fingerprint: str) -> Column:
    """Ten hexadecimal digits a bin: two for its number, eight for its tuple."""
    return F.expr(f"array_join(transform(`{fingerprint}`, s -> lower(lpad(hex(s), 10, '0'))), '')")


def _cuts(docs: DataFrame, key: str, parts: int, each: int = 16) -> list:
    """At most `parts` values of the key, descending from its largest, that part its distinct values about evenly."""
    ids = docs.select(key).filter(F.col(key).isNotNull()).distinct()
    drawn = sorted((r[0] for r in ids.orderBy(F.xxhash64(key), key).limit(parts * each).collect()), reverse=True)
    largest = docs.agg(F.max(key)).first()[0]
    return [] if largest is None else sorted({largest, *drawn[each::each]}, reverse=True)


def with_next(docs: DataFrame, key: str, carried: list[str], prefix: str) -> DataFrame:
    """Each row and the `carried` columns of the next one by descending key, named with `prefix`; after the last comes the first.

    Rows without a key come last; rows that share a key stand in the order of a hash of the carried columns. Keys are cut into ranges at
    keys that occur, so a range's first row is known ahead: it is sent to the range before it as well and meets its
    predecessor there. One shuffle; the list of cuts is bounded by the number of shuffle partitions.
    """
    cuts = _cuts(docs, key, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = F.lit(cuts) if cuts else F.array().cast("array<bigint>")
    last = F.lit(len(cuts))
    own = F.when(F.col(key).isNull(), last).otherwise(F.size(F.filter(bounds, lambda b: b >= F.col(key))))
    begins = F.array_contains(bounds, F.col(key)) if cuts else F.lit(True)
    before = F.when(own > 1, own - 1).otherwise(last)
    real, guest = F.struct(own.alias("part"), F.lit(0).alias("guest")), F.struct(before.alias("part"), F.lit(1).alias("guest"))
    places = F.when(F.coalesce(begins, F.lit(False)), F.array(real, guest)).otherwise(F.array(real))
    dealt = docs.select("*", F.explode(places).alias("_omh_place"))
    order = Window.partitionBy("_omh_place.part").orderBy(
        "_omh_place.guest", F.desc_nulls_last(key), F.xxhash64(*carried), *carried
    )
    following = F.lead(F.struct(*carried)).over(order)
    met = dealt.select("*", following.alias("_omh_next")).filter("_omh_place.guest = 0")
    return met.select(*docs.columns, *[F.col(f"_omh_next.{c}").alias(f"{prefix}{c}") for c in carried])


def fingerprint_documents(docs: DataFrame, how: OrderMinHash = OrderMinHash()) -> DataFrame:
    """A row a document: its fingerprint, that of its edited text, and how like they and the next document's are.

    The edited text has the last third (rounded down) of the code points replaced by the first as many, or all, of the next document
    by descending doc_id; after the last comes the first. Null texts are empty, texts of any length are taken whole, one
    row's arrays at a time. Rows that repeat each give a row; where ids repeat or are null, `with_next` says which row is the next.
    A single document is its own next one; an empty table gives an empty result. Of other columns, whatever their names, none is read.
    """
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    signed = add_fingerprint(given, "text", "signature", how)
    met = with_next(signed, "doc_id", ["text", "signature"], "next_")
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    met = met.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "signature", "next_signature"
    )
    both = add_fingerprint(met, "edited", "edited_signature", how)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("signature").alias("fingerprint"),
        as_text("edited_signature").alias("edited_fingerprint"),
        likeness("signature", "edited_signature", how).alias("near_edited"),
        likeness("signature", "next_signature", how).alias("near_next"),
    )
