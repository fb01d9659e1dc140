"""SimHash document fingerprints, in DataFrame expressions only.

Every word votes with its weight on each of 64 signed bits of its hash; the
signs of the sums are the fingerprint. Near fingerprints are found through
permuted block tables: bits are cut into blocks, and within a Hamming radius
at least ``agree`` of ``radius + agree`` blocks are equal, so each choice of
``agree`` blocks is the key of one table.

Cases: a null or empty text has no words and the fingerprint 0; very long
texts are read whole, their votes summed in chunks; equal texts have equal
fingerprints; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veloframe.llm.common import written

#: Four 16-bit counters of one long; bit k of a hash goes to lane k // 16 of counter k % 16.
LANES, MASK, STEP = 4, 0x0001000100010001, 16
#: Words whose weights cannot reach a counter's last bit (the long's sign): CHUNK * MOST_WEIGHT < 2 ** 15.
CHUNK, MOST_WEIGHT = 512, 63
BLANK = r"[ \t\n\x0B\f\r]+"


def weighted_terms(text: Column) -> Column:
    """array<struct<h, w>>: hash and weight of each word; longer words, being rarer, weigh more."""
    words = F.filter(F.split(text, BLANK), lambda x: x != "")
    return F.transform(words, lambda x: F.struct(
        F.xxhash64(x).alias("h"),
        F.least(F.char_length(x) * F.char_length(x), F.lit(MOST_WEIGHT)).cast("long").alias("w")))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprint(text: Column) -> Column:
    """The 64-bit SimHash of a text, as a long."""
    zero = F.struct(*(F.lit(0).cast("long").alias(f"c{k}") for k in range(STEP)), F.lit(0).cast("long").alias("all"))

    def vote(acc: Column, x: Column) -> Column:
        h, w = x["h"], x["w"]
        counters = [(acc[f"c{k}"] + (F.shiftrightunsigned(h, k) if k else h).bitwiseAND(F.lit(MASK)) * w
                     ).alias(f"c{k}") for k in range(STEP)]
        return F.struct(*counters, (acc["all"] + w).alias("all"))

    def sums(terms: Column) -> Column:
        """Counters and total weight of each chunk of terms."""
        starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(terms), F.lit(1)) - 1) / CHUNK).cast("int"))
        return F.transform(starts, lambda c: F.aggregate(
            F.slice(terms, c * CHUNK + 1, CHUNK), zero, vote,
            lambda acc: F.struct(F.array(*(acc[f"c{k}"] for k in range(STEP))).alias("c"), acc["all"].alias("all"))))

    def total(chunks: Column, of_chunk: Callable[[Column], Column]) -> Column:
        return F.aggregate(chunks, F.lit(0).cast("long"), lambda a, x: a + of_chunk(x))

    def signs(chunks: Column) -> Column:
        def set_bit(weight: Column, out: Column, bit: Column) -> Column:
            lane = F.floor(bit / STEP).cast("int") * 16
            ones = total(chunks, lambda x: F.call_function("shiftrightunsigned", x["c"][bit % STEP], lane)
                         .bitwiseAND(F.lit(0xFFFF)))
            return F.when(2 * ones > weight, out.bitwiseOR(
                F.call_function("shiftleft", F.lit(1).cast("long"), bit))).otherwise(out)

        bits = F.sequence(F.lit(0), F.lit(LANES * STEP - 1))
        return bound(total(chunks, lambda x: x["all"]), lambda weight: F.aggregate(
            bits, F.lit(0).cast("long"), lambda out, bit: set_bit(weight, out, bit)))

    return bound(weighted_terms(text), lambda terms: bound(sums(terms), signs))


def voted(rows: DataFrame, bodies: dict[str, str]) -> DataFrame:
    """``rows`` without their texts, each text column of ``bodies`` replaced by its fingerprint under the
    given name; the other columns together must name a row.

    The same votes as ``fingerprint``, as a grouped sum: words become rows, which generated code adds up to
    packed counters per ``CHUNK`` words in the task that reads the text, and only those sums, few per text,
    are shuffled to be unpacked and added.
    """
    kept = [c for c in rows.columns if c not in bodies]
    which = F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).alias("body")) for k, c in enumerate(bodies)))
    words = (rows.select(*kept, F.explode(which).alias("x"))
             .select(*kept, F.col("x.k").alias("__k"), F.posexplode(F.split("x.body", BLANK)).alias("__at", "__word")))
    length = F.char_length("__word")
    words = words.select(*kept, "__k", F.floor(F.col("__at") / CHUNK).cast("int").alias("__chunk"),
                         F.xxhash64("__word").alias("h"),
                         F.least(length * length, F.lit(MOST_WEIGHT)).cast("long").alias("w"))  # 0 for no word
    counters = [F.sum((F.shiftrightunsigned("h", k) if k else F.col("h")).bitwiseAND(F.lit(MASK)) * F.col("w")).alias(f"c{k}")
                for k in range(STEP)]
    packed = words.groupBy(*kept, "__k", "__chunk").agg(*counters, F.sum("w").alias("all"))
    lanes = [F.sum(F.shiftrightunsigned(f"c{k}", 16 * lane).bitwiseAND(F.lit(0xFFFF))).alias(f"b{STEP * lane + k}")
             for lane in range(LANES) for k in range(STEP)]
    sums = packed.groupBy(*kept, "__k").agg(*lanes, F.sum("all").alias("all"))
    ones = [F.when(2 * F.col(f"b{b}") > F.col("all"), F.lit(1 << b if b < 63 else -1 << 63)).otherwise(F.lit(0))
            for b in range(LANES * STEP)]
    made = sums.select(*kept, "__k", reduce(Column.bitwiseOR, ones).alias("__print"))
    return made.groupBy(*kept).agg(*(F.max(F.when(F.col("__k") == k, F.col("__print"))).alias(name)
                                     for k, name in enumerate(bodies.values())))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


KEY = ["id", "tie"]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with their key: the id in order, nulls first, and a hash of the text."""
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63)).alias("id"),
                       F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, id, tie, n_chars, copies) of each distinct row of ``docs``, with the key of the next
    distinct row (``next_``) and key and n_chars of the previous one (``prev_``) by descending doc_id,
    the first following the last.

    A null id comes after all others, and rows of one id are ordered by ``tie``. Rows are
    range-partitioned and written with their partition; only one row per partition is ordered in one
    place.
    """
    ranged = written(
        keyed(docs).groupBy("doc_id", *KEY).agg(F.max(F.char_length("text")).alias("n_chars"),
                                                F.count("*").alias("copies"))
        .repartitionByRange(F.desc("id"), "tie").withColumn("part", F.spark_partition_id()), "fp-order")
    order = Window.partitionBy("part").orderBy(F.desc("id"), "tie")
    rows = (ranged.withColumn("me", F.struct(*KEY, "n_chars")).withColumn("place", F.row_number().over(order))
            .withColumn("after", F.lead("me").over(order)).withColumn("before", F.lag("me").over(order)))
    ends = rows.groupBy("part").agg(F.min_by("me", "place").alias("first"), F.max_by("me", "place").alias("last"))
    every = Window.partitionBy(F.lit(0)).orderBy("part")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part", F.coalesce(F.lead("first").over(every), F.first("first").over(whole)).alias("following"),
        F.coalesce(F.lag("last").over(every), F.last("last").over(whole)).alias("preceding"))
    near = rows.join(F.broadcast(ends), "part").select(
        "doc_id", "me", "copies", F.coalesce("after", "following").alias("next"),
        F.coalesce("before", "preceding").alias("prev"))
    return near.select("doc_id", "me.*", "copies", *(F.col(f"next.{c}").alias(f"next_{c}") for c in KEY),
                       *(F.col(f"prev.{c}").alias(f"prev_{c}") for c in (*KEY, "n_chars")))


def edited(docs: DataFrame) -> DataFrame:
    """Each document with its edited text: its last third of code points replaced by the first as
    many (or all) of the next document.

    Columns doc_id, id, tie, n_chars, next_id, next_tie, text, edited and ``rows``, the number of rows
    that are so. Of equal rows, all but one are followed by their like. Texts are shuffled once.
    """
    once = F.row_number().over(Window.partitionBy(*KEY).orderBy("tie"))
    texts = keyed(docs).select(*KEY, "text").withColumn("nth", once).where("nth = 1").drop("nth")
    linked = texts.join(neighbours(docs), KEY)
    heads = linked.select(*(F.col(f"prev_{k}").alias(k) for k in KEY),
                          F.expr("left(text, cast(floor(prev_n_chars / 3) as int))").alias("head"))
    third = "cast(floor(n_chars / 3) as int)"
    by_next = F.struct(F.lit(1).cast("long").alias("rows"), "next_id", "next_tie",
                       F.expr(f"concat(left(text, n_chars - {third}), head)").alias("edited"))
    by_like = F.struct((F.col("copies") - 1).alias("rows"), F.col("id").alias("next_id"), F.col("tie").alias("next_tie"),
                       F.expr(f"concat(left(text, n_chars - {third}), left(text, {third}))").alias("edited"))
    kinds = F.when(F.col("copies") > 1, F.array(by_next, by_like)).otherwise(F.array(by_next))
    return (linked.select("doc_id", *KEY, "n_chars", "copies", "text", "next_id", "next_tie").join(heads, KEY)
            .select("doc_id", *KEY, "n_chars", "text", F.explode(kinds).alias("kind"))
            .select("doc_id", *KEY, "n_chars", "text", "kind.*"))


def near_counts(prints: DataFrame, radius: int = 3, agree: int = 2) -> DataFrame:
    """(fingerprint, n_near): how many other fingerprints of ``prints`` lie within ``radius`` bits.

    ``prints`` holds distinct fingerprints. Every pair is counted in the first table only whose
    blocks all agree.
    """
    n_blocks = radius + agree
    cuts = [64 * k // n_blocks for k in range(n_blocks + 1)]

    def block(value: Column, k: int) -> Column:
        return F.shiftrightunsigned(value, cuts[k]).bitwiseAND(F.lit((1 << cuts[k + 1] - cuts[k]) - 1))

    tables = list(combinations(range(n_blocks), agree))
    keys = F.array(*(F.struct(F.lit(t).alias("t"), *(block(F.col("fingerprint"), k).alias(f"b{j}")
                                                     for j, k in enumerate(chosen)))
                     for t, chosen in enumerate(tables)))
    rows = prints.select("fingerprint", F.explode(keys).alias("k")).select("fingerprint", "k.*")
    a, b = rows.alias("a"), rows.alias("b")
    x, y = F.col("a.fingerprint"), F.col("b.fingerprint")
    equal = [block(x, k) == block(y, k) for k in range(n_blocks)]
    first = F.lit(len(tables))
    for t, chosen in reversed(list(enumerate(tables))):
        all_equal = equal[chosen[0]]
        for k in chosen[1:]:
            all_equal = all_equal & equal[k]
        first = F.when(all_equal, F.lit(t)).otherwise(first)
    same_key = [F.col("a.t") == F.col("b.t"), *(F.col(f"a.b{j}") == F.col(f"b.b{j}") for j in range(agree))]
    pairs = a.join(b, [*same_key, x < y, F.bit_count(x.bitwiseXOR(y)) <= radius, first == F.col("a.t")])
    return (pairs.select(F.explode(F.array(x, y)).alias("fingerprint"))
            .groupBy("fingerprint").agg(F.count("*").alias("n_near")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_chars, edited_sha256, both fingerprints, the likenesses
    and ``n_near``, the number of other fingerprints in the table within three bits."""
    rows = edited(docs).select(
        "doc_id", *KEY, "n_chars", "rows", "next_id", "next_tie",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "text", "edited")
    made = written(voted(rows, {"text": "fingerprint", "edited": "edited_fingerprint"}), "fp-made")
    other = made.select(F.col("id").alias("next_id"), F.col("tie").alias("next_tie"),
                        F.col("fingerprint").alias("next_fingerprint")).distinct()
    counts = near_counts(made.select("fingerprint").distinct())
    return (made.join(other, ["next_id", "next_tie"]).join(counts, "fingerprint", "left")
            .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                    as_hex(F.col("fingerprint")).alias("fingerprint"),
                    as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                    F.coalesce("n_near", F.lit(0)).alias("n_near")))
