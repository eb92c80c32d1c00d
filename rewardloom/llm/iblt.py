"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, in DataFrame functions only.

A paragraph is a sentence or a line without one: every text, of whatever length, is cut at line feeds and at spaces
behind a full stop, exclamation or question mark.  A document's set of paragraphs becomes a set of 64-bit digests.  A sketch is 3 rows of ``CELLS`` cells; a
digest goes into one cell of each row, which keeps how many digests it holds and the exclusive-or of
the digests and of their check hashes.  Two sketches subtract cell by cell; digests
in both cancel out.  A cell left with one digest (count 1 or -1, and its check hash fits) gives
that digest away; taking it out of its other cells frees more, until all cells are empty or none is left with one.

The fingerprint is the sketch in text: the number of digests, then the cells in hex.  Two documents are compared by sketches
of a common size, which both sides' numbers of digests give (what differs is at most both together): a row a cell, as sums and
exclusive-ors of what goes into it, the second document's with the sign turned, so that adding up subtracts.  Each turn of
peeling is one more such sum, in the pair's own partition.  Cells are rows, so a document of a million lines is many small
rows.  Pairs that don't come out empty are tried again with four times the cells, salted anew; what ``tries`` rounds
leave (equal check hashes) is compared as sets.  Likeness: digests in both over digests in either.

Edited text: the last floor(n/4) code points give way to the first as many of the next document, by
ascending doc_id (null first, then by text hash), after the last the first.  Next documents come from a numbering of the
(doc_id, text hash) rows; a text moves once by its key, and only the prefix asked for moves to its taker.

Defined cases: a null text is the empty text, whose one line is empty; rows equal in id and text are one
document to the numbering and are all returned; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rewardloom.llm.common import column_or_null, materialize
from rewardloom.operators.indexing import sequential_index

ROWS, CELLS = 3, 8                  # of the published sketch
FIRST_TURNS, MORE_TURNS = 5, 9      # a turn peels one row; the first ones empty all but about a pair in a hundred
ONLY_A, ONLY_B = -1, -2             # cells that count what was found


def digests(text: Column) -> Column:
    cut = F.split(text, r"\n|(?<=[.!?]) ", -1)
    return F.array_sort(F.array_distinct(F.transform(cut, lambda x: F.xxhash64(x))))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7)).bitwiseAND(F.lit(0xFFFFFFFF))


def _places(key: Column, salt: Column) -> Column:
    """The digest's cell in each row, rows one after the other."""
    h = F.xxhash64(key, salt)
    bits = CELLS.bit_length() - 1
    return F.array(*[F.shiftrightunsigned(h, 8 * r).bitwiseAND(F.lit((1 << bits) - 1)).cast("int") + r * CELLS for r in range(ROWS)])


def _one(key: Column, salt: Column) -> Column:
    return F.struct(key.alias("k"), _check(key).alias("c"), _places(key, salt).alias("at"))


def sketch(keys: Column, salt: Column) -> Column:
    """Array of cells (n, k, c) of an array of digests."""
    none = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c"))

    def put(cell, item):
        return F.struct((cell["n"] + 1).alias("n"), cell["k"].bitwiseXOR(item["k"]).alias("k"), cell["c"].bitwiseXOR(item["c"]).alias("c"))

    def cells(items):
        return F.array(*[F.aggregate(F.filter(items, lambda x: x["at"][i // CELLS] == i), none, put)  # noqa: B023
                         for i in range(ROWS * CELLS)])

    # the array of one binds the items to a variable, so they aren't made again for every cell
    return F.element_at(F.transform(F.array(F.transform(keys, lambda k: _one(k, salt))), cells), 1)


def as_text(keys: Column, cells: Column) -> Column:
    cell = lambda c: F.when((c["n"] == 0), F.lit("")).otherwise(
        F.concat_ws(":", F.hex(c["n"].cast("long")), F.hex(c["k"]), F.hex(c["c"])))
    return F.concat_ws(";", F.size(keys).cast("string"), F.array_join(F.transform(cells, cell), ","))


def _width(number: int) -> Column:
    """Cells a row of a pair's sketches: a power of two that holds both sides, four times as many each further try."""
    return F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.col("n_a") + F.col("n_b"))), F.lit(6)) + 2 * number).cast("long")


def _cell(key: Column, row: int, number: int) -> Column:
    return F.xxhash64(key, F.lit(number), F.lit(row)).bitwiseAND(_width(number) - 1) * ROWS + row


def _put(cell: Column, n: Column, k: Column, c: Column, found: Column) -> Column:
    return F.struct(cell.cast("long").alias("cell"), n.cast("long").alias("n"), k.alias("k"), c.alias("c"), found.alias("found"))


def _added(puts: DataFrame, kept: list[str]) -> DataFrame:
    """Cells as sums of what was put into them; empty ones leave, the counts of what was found (cells below 0) stay."""
    return (puts.groupBy(*kept, "cell", "found").agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
            .where("cell < 0 OR n <> 0 OR k <> 0 OR c <> 0"))


def _difference(pairs: DataFrame, kept: list[str], number: int) -> DataFrame:
    """The sketch of ``a`` less that of ``b``, a row a cell that isn't empty, and a first count of nothing found."""
    zero = F.lit(0).cast("long")
    signed = lambda c, sign: F.transform(c, lambda k: F.struct(k.alias("key"), F.lit(sign).alias("sign")))
    head = F.array(F.struct(F.lit(None).cast("long").alias("key"), F.lit(0).alias("sign")))
    items = pairs.select(*kept, F.inline(F.concat(head, signed(F.col("a"), 1), signed(F.col("b"), -1))))
    key, sign = F.col("key"), F.col("sign")
    puts = F.when(key.isNull(), F.array(_put(F.lit(ONLY_A), sign, zero, zero, zero))).otherwise(
        F.array(*[_put(_cell(key, r, number), sign, key, _check(key), zero) for r in range(ROWS)]))
    return _added(items.select(*kept, F.inline(puts)), kept)


def _peeled(cells: DataFrame, kept: list[str], number: int, turns: int, digests: bool) -> DataFrame:
    """Each turn takes the digests that are alone in a cell of one row out of the other rows; within a row a digest has one
    cell, so none is taken twice.  In the end a row a pair: what was found and the cells that are left."""
    zero, n, k, c = F.lit(0).cast("long"), F.col("n"), F.col("k"), F.col("c")
    for turn in range(turns):
        row = turn % ROWS
        lone = (F.col("cell") % ROWS == row) & (F.abs(n) == 1) & (c == _check(k))
        given = _put(F.when(n == 1, ONLY_A).otherwise(ONLY_B), F.lit(1), zero, zero, k if digests else zero)
        out = [_put(_cell(k, r, number), -n, k, c, zero) for r in range(ROWS) if r != row]
        stays = F.array(_put(F.col("cell"), n, k, c, F.col("found")))
        cells = _added(cells.select(*kept, F.inline(F.when(lone, F.array(given, *out)).otherwise(stays))), kept)
    of = lambda which: F.col("cell") == which
    lists = [F.collect_list(F.when(of(which) & (n > 0), F.col("found"))).alias(name)
             for which, name in ((ONLY_A, "digests_a"), (ONLY_B, "digests_b"))] if digests else []
    return cells.groupBy(*kept).agg(
        *[F.coalesce(F.sum(F.when(of(which), n)), zero).cast("int").alias(name) for which, name in ((ONLY_A, "only_a"), (ONLY_B, "only_b"))],
        *lists, F.collect_list(F.when(F.col("cell") >= 0, _put(F.col("cell"), n, k, c, zero))).alias("rest"))


def differences(pairs: DataFrame, key: tuple[str, ...] = ("pair",), tries: int = 14, digests: bool = False, placed: bool = False) -> DataFrame:
    """(key, a, b: arrays of distinct digests) -> (key, n_a, n_b, only_a, only_b), the sizes of the sets and of the
    differences that the sketches gave back; with ``digests`` also the digests themselves, ``digests_a`` and ``digests_b``.
    ``placed``: rows are already partitioned by columns of the key, as a join on them leaves them; else they move once.
    Cells never move in the first turns: a pair's cells are made and peeled in its own partition."""
    kept, names = [*key, "n_a", "n_b"], ["only_a", "only_b"] + (["digests_a", "digests_b"] if digests else [])
    zero = F.lit(0).cast("long")
    todo = pairs.select(*key, F.size("a").alias("n_a"), F.size("b").alias("n_b"), "a", "b")
    todo, done = todo if placed else todo.repartition(*key), []
    for number in range(tries + 1):
        first = materialize(_peeled(_difference(todo, kept, number), kept, number, FIRST_TURNS, digests), f"sketch-try{number}")
        done.append(first.where(F.size("rest") == 0).select(*kept, *names))
        stuck = first.where(F.size("rest") > 0)
        if stuck.isEmpty():
            break
        back = [F.transform(F.col(f"digests_{x}"), lambda d, w=w: _put(F.lit(w), F.lit(1), zero, zero, d)) if digests else
                F.array(_put(F.lit(w), F.col(f"only_{x}"), zero, zero, zero)) for x, w in (("a", ONLY_A), ("b", ONLY_B))]
        cells = stuck.select(*kept, F.inline(F.concat(*back, "rest")))
        last = materialize(_peeled(cells, kept, number, MORE_TURNS, digests), f"sketch-more{number}")
        done.append(last.where(F.size("rest") == 0).select(*kept, *names))
        failed = last.where(F.size("rest") > 0).select(*key)
        if failed.isEmpty():
            break
        todo = todo.join(failed, list(key), "left_semi")
    else:
        a, b = F.array_except("a", "b"), F.array_except("b", "a")
        done.append(todo.select(*kept, F.size(a).alias("only_a"), F.size(b).alias("only_b"),
                                *([a.alias("digests_a"), b.alias("digests_b")] if digests else [])))
    return reduce(lambda x, y: x.unionByName(y), done)


def likeness(n_a: Column, n_b: Column, only_a: Column, only_b: Column) -> Column:
    return (n_a - only_a) / (n_a + only_b)


def fingerprint(docs: DataFrame, **how) -> DataFrame:
    """Rows (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    key = ["none", "id", "h"]         # whether the id is null, the id, the text's hash: plain columns, so that both joins below share one shuffle
    doc_id, text = column_or_null(docs, "doc_id", "long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(doc_id.isNull().alias("none"), F.coalesce(doc_id, F.lit(0)).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    light = rows.groupBy(*key).agg(F.first(F.length("text")).alias("n"), F.count(F.lit(1)).alias("copies"))
    numbered = materialize(sequential_index(light, [F.col("none").desc(), "id", "h"], "at"), "sketch-order")
    total, copies = numbered.agg(F.count(F.lit(1)), F.max("copies")).first()
    after = numbered.select(F.pmod(F.col("at") + 1, F.lit(max(total, 1))).alias("next"), F.col("none").alias("to_none"),
                            F.col("id").alias("to_id"), F.col("h").alias("to_h"), F.floor(F.col("n") / 4).cast("int").alias("want"))
    plan = numbered.join(after, F.col("at") == F.col("next")).select(*key, "n", "at", "to_none", "to_id", "to_h", "want")
    # the text goes by its key in one shuffle; only the prefix that the document before asks for goes on
    keyed = rows.join(plan, key)
    given = (keyed.select(F.col("to_none").alias("none"), F.col("to_id").alias("id"), F.col("to_h").alias("h"),
                          F.expr("substring(text, 1, want)").alias("prefix")).groupBy(*key).agg(F.min("prefix").alias("prefix")))
    texts = (keyed.join(given, key)
             .select("at", F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n", "text",
                     F.concat(F.expr("substring(text, 1, n - cast(floor(n / 4) AS int))"), "prefix").alias("edited")))
    zero = F.lit(0).cast("long")
    with_keys = texts.select("at", "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                             digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("b"))
    base = materialize(with_keys, "sketch-digests")
    one = base.dropDuplicates(["at"]) if (copies or 0) > 1 else base        # rows equal in id and text are compared once
    own = one.select("at", "a", "b")
    following = one.select(F.pmod(F.col("at") - 1, F.lit(max(total, 1))).alias("at"), F.col("a").alias("next"))
    both = F.array(*[F.struct(F.lit(edited).alias("edited"), F.col("a").alias("a"), F.col(other).alias("b"))
                     for edited, other in ((True, "b"), (False, "next"))])
    pairs = own.join(following, "at").select("at", F.inline(both))
    near = differences(pairs, ("at", "edited"), placed=True, **how).select(
        "at", "edited", likeness(F.col("n_a"), F.col("n_b"), F.col("only_a"), F.col("only_b")).alias("near"))
    near = near.groupBy("at").agg(F.max(F.when(F.col("edited"), F.col("near"))).alias("near_edited"),
                                  F.max(F.when(~F.col("edited"), F.col("near"))).alias("near_next"))
    return (base.join(near, "at").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("a"), sketch(F.col("a"), zero)).alias("fingerprint"),
        as_text(F.col("b"), sketch(F.col("b"), zero)).alias("edited_fingerprint"), "near_edited", "near_next"))
