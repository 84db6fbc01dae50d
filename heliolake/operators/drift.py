"""Problem 3: files whose fields come, go, change name or type; one table and a list of changes.

1. Every field of every file is profiled in one aggregate: JSON types, filled values, and a
   theta sketch of its values (bounded size, mergeable).
2. The profiles of successive files are compared. Fields of one side only are candidates for
   a rename, and so are fields of both sides whose sketches share next to nothing.
3. Only for files with candidates on both sides, redelivered records are paired by values that
   occur once in either file; at least two must agree where records have two. Agreement of
   each old with each new candidate over these pairs, beyond what chance would give, weighs the
   edge between them, with a little for similar names and equal types.
4. An optimal bipartite matching per pair of files decides the renames. What is left is added
   or removed.
5. Chains of renames give every field of every file its canonical name, and the union of all
   files reads as one table per dataset.

Values move by hash of (file, value), never by file or dataset, so no large file fills a task;
what one task holds whole is a file's list of fields.

Defined results: a payload that is no JSON object has no fields; null counts as present but has
no type; a field with several types in one file has them all, in alphabetical order; files are
ordered by number, then name, null numbers first; the first file of a dataset has no changes.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliolake.session import cut, cut_table

#: Least agreement beyond chance, over the redelivered records, that makes a rename.
AGREEMENT = 0.5
#: Least number of agreeing values.
EVIDENCE = 2
#: Shared names whose sketches, each of at least so many values, have less than this share in common are looked into.
DISTINCT, STRANGE = 20, 0.2
#: Weight of name similarity and of equal types against agreement, which weighs 1.
NAME_WEIGHT, TYPE_WEIGHT = 0.05, 0.02


def json_type(v: Column) -> Column:
    """JSON type of a variant; null for null."""
    s = F.schema_of_variant(v)
    return (
        F.when(s.isNull() | (s == "VOID"), F.lit(None).cast("string"))
        .when(s.startswith("OBJECT"), "object")
        .when(s.startswith("ARRAY"), "array")
        .when(s == "STRING", "string")
        .when(s == "BOOLEAN", "boolean")
        .otherwise("number")
    )


def fields_of(lines: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per record and field: ``name, type, value`` (text; objects and arrays as JSON), and ``canon``, equal for 1.5 and "1.5"."""
    v = F.from_json(F.col(payload), "map<string,variant>")
    out = lines.withColumn("__f", F.explode(F.map_entries(v))).drop(payload)
    out = out.select(*[c for c in out.columns if c != "__f"], F.col("__f.key").alias("name"), F.col("__f.value").alias("__v"))
    out = out.withColumn("type", json_type(F.col("__v")))
    out = out.withColumn("value", F.when(F.col("type").isin("object", "array"), F.to_json("__v")).when(F.col("type").isNotNull(), F.col("__v").cast("string"))).drop("__v")
    number = F.when(F.col("type").isin("number", "string"), F.trim("value").try_cast("double"))
    return out.withColumn("canon", F.coalesce(number.cast("string"), F.col("value")))


def similarity(a: Column, b: Column) -> Column:
    """1 for equal names up to case, 0 for nothing in common."""
    longest = F.greatest(F.length(a), F.length(b), F.lit(1))
    return 1 - F.levenshtein(F.lower(a), F.lower(b)) / longest


def best_matching(weights: list[list[float]]) -> list[tuple[int, int]]:
    """Pairs (row, column) of a matching of greatest total weight; pairs of weight 0 are not made.

    Shortest augmenting paths over row and column potentials; cubic in the number of fields.
    """
    rows, cols = len(weights), len(weights[0]) if weights else 0
    n = max(rows, cols)
    if not n:
        return []
    top = max((w for r in weights for w in r), default=0.0)
    cost = [[top - (weights[i][j] if i < rows and j < cols else 0.0) for j in range(n)] for i in range(n)]
    inf = float("inf")
    row_price, col_price, owner = [0.0] * (n + 1), [0.0] * (n + 1), [n] * (n + 1)
    for new in range(n):
        owner[n] = new
        at, least, via, seen = n, [inf] * n, [n] * n, set()
        while owner[at] != n:
            seen.add(at)
            i, step, to = owner[at], inf, n
            for j in range(n):
                if j not in seen:
                    d = cost[i][j] - row_price[i] - col_price[j]
                    if d < least[j]:
                        least[j], via[j] = d, at
                    if least[j] < step:
                        step, to = least[j], j
            for j in seen:
                row_price[owner[j]] += step
                col_price[j] -= step
            for j in range(n):
                if j not in seen:
                    least[j] -= step
            at = to
        while at != n:
            owner[at] = owner[via[at]]
            at = via[at]
    return [(owner[j], j) for j in range(cols) if owner[j] < rows and weights[owner[j]][j] > 0]


def _match(pdf: pd.DataFrame) -> pd.DataFrame:
    old, new = sorted(set(pdf["old_name"])), sorted(set(pdf["new_name"]))
    weight = {(o, n): w for o, n, w in zip(pdf["old_name"], pdf["new_name"], pdf["weight"])}
    pairs = best_matching([[weight.get((o, n), 0.0) for n in new] for o in old])
    return pd.DataFrame({"dataset_name": pdf["dataset_name"].iloc[0], "file_no": pdf["file_no"].iloc[0], "old_name": [old[i] for i, _ in pairs], "new_name": [new[j] for _, j in pairs]})


def numbered_files(lines: DataFrame) -> DataFrame:
    """``dataset_name, source_file, file_seq, file_no``: the place of each file in its dataset, from 1."""
    files = lines.select("dataset_name", "source_file", "file_seq").distinct()
    order = Window.partitionBy("dataset_name").orderBy(F.col("file_seq").asc_nulls_first(), F.col("source_file").asc_nulls_first())
    return files.withColumn("file_no", F.row_number().over(order))


def profiled(lines: DataFrame, record: str = "record_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(files, fields of all records, profile of each field of each file); fields and profiles are written once."""
    lines = lines.select("dataset_name", "source_file", "file_seq", "payload", record)
    files = cut(numbered_files(lines))
    other = files.select(F.col("dataset_name").alias("__d"), F.col("source_file").alias("__s"), F.col("file_seq").alias("__q"), "file_no")
    same = F.col("dataset_name").eqNullSafe(F.col("__d")) & F.col("source_file").eqNullSafe(F.col("__s")) & F.col("file_seq").eqNullSafe(F.col("__q"))
    keyed = lines.join(other, same).select("dataset_name", "file_no", F.col(record).alias("rec"), "payload")
    fields = cut_table(fields_of(keyed))
    profile = fields.groupBy("dataset_name", "file_no", "name").agg(
        F.array_join(F.array_sort(F.collect_set("type")), "|").alias("types"), F.count("canon").alias("filled"), F.expr("theta_sketch_agg(canon)").alias("sketch")
    )
    return files, fields, cut(profile)


def renames(fields: DataFrame, compared: DataFrame) -> DataFrame:
    """``dataset_name, file_no, old_name, new_name``: fields that go on under another name."""
    old_c = compared.filter("old_candidate").select("dataset_name", "file_no", F.col("old_name").alias("name"))
    new_c = compared.filter("new_candidate").select("dataset_name", "file_no", F.col("new_name").alias("name"))
    key = ["dataset_name", "file_no"]
    open_ = cut(old_c.select(*key).distinct().join(new_c.select(*key).distinct(), key, "left_semi"))

    named = fields.filter(F.col("canon").isNotNull()).select(*key, "rec", "name", "canon")
    old = named.withColumn("file_no", F.col("file_no") + 1).join(open_, key, "left_semi")
    new = named.join(open_, key, "left_semi")

    def once(side: DataFrame) -> DataFrame:
        """Values that occur once in their file."""
        return side.groupBy(*key, "canon").agg(F.count("*").alias("c"), F.first("rec").alias("rec")).filter("c = 1").select(*key, "canon", "rec")

    shared = once(old).withColumnRenamed("rec", "old_rec").join(once(new).withColumnRenamed("rec", "new_rec"), [*key, "canon"])
    votes = shared.groupBy(*key, "old_rec", "new_rec").agg(F.count("*").alias("votes"))
    sizes_o = old.groupBy(*key, F.col("rec").alias("old_rec")).agg(F.count("*").alias("so"))
    sizes_n = new.groupBy(*key, F.col("rec").alias("new_rec")).agg(F.count("*").alias("sn"))
    linked = votes.join(sizes_o, [*key, "old_rec"]).join(sizes_n, [*key, "new_rec"]).filter((F.col("votes") >= 2) | (F.least("so", "sn") == 1)).select(*key, "old_rec", "new_rec")

    # values of the candidates alone, over the linked records
    o = old.join(old_c, [*key, "name"], "left_semi").select(*key, F.col("rec").alias("old_rec"), F.col("name").alias("old_name"), F.col("canon").alias("old_canon"))
    n = new.join(new_c, [*key, "name"], "left_semi").select(*key, F.col("rec").alias("new_rec"), F.col("name").alias("new_name"), F.col("canon").alias("new_canon"))
    both = linked.join(o, [*key, "old_rec"]).join(n, [*key, "new_rec"])
    both = cut(both.groupBy(*key, "old_name", "new_name", "old_canon", "new_canon").agg(F.count("*").alias("c")))
    pair = [*key, "old_name", "new_name"]
    total = both.groupBy(*pair).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("old_canon") == F.col("new_canon"), F.col("c")).otherwise(0)).alias("equal"))
    # agreement by chance: the product of the shares of each value on either side
    left = both.groupBy(*pair, F.col("old_canon").alias("v")).agg(F.sum("c").alias("co"))
    right = both.groupBy(*pair, F.col("new_canon").alias("v")).agg(F.sum("c").alias("cn"))
    chance = left.join(right, [*pair, "v"]).groupBy(*pair).agg(F.sum(F.col("co") * F.col("cn")).alias("together"))
    scored = total.join(chance, pair, "left").withColumn("chance", F.coalesce("together", F.lit(0)) / (F.col("n") * F.col("n")))
    beyond = F.when(F.col("chance") < 1, (F.col("equal") / F.col("n") - F.col("chance")) / (1 - F.col("chance"))).otherwise(F.lit(0.0))
    scored = scored.withColumn("beyond", beyond).filter((F.col("beyond") >= AGREEMENT) & (F.col("equal") >= EVIDENCE))
    types = compared.select(*key, F.col("old_name"), F.col("old_types")).filter("old_name IS NOT NULL")
    types_n = compared.select(*key, F.col("new_name"), F.col("new_types")).filter("new_name IS NOT NULL")
    scored = scored.join(types, [*key, "old_name"], "left").join(types_n, [*key, "new_name"], "left")
    same_name = F.when(F.col("old_name") == F.col("new_name"), 1.0).otherwise(0.0)
    weight = F.col("beyond") + same_name + NAME_WEIGHT * similarity(F.col("old_name"), F.col("new_name")) + TYPE_WEIGHT * F.when(F.col("old_types") == F.col("new_types"), 1.0).otherwise(0.0)
    scored = scored.withColumn("weight", weight)
    matched = scored.groupBy(*key).applyInPandas(_match, "dataset_name string, file_no int, old_name string, new_name string")
    return matched.filter("old_name <> new_name")


def compare(profile: DataFrame) -> DataFrame:
    """Each field of a file beside its namesake in the file before, and whether either may be part of a rename."""
    now = profile.filter("file_no > 1").select("dataset_name", "file_no", F.col("name").alias("n"), F.col("types").alias("new_types"), F.col("sketch").alias("new_sketch"))
    last = profile.agg(F.max("file_no")).first()[0] or 0
    before = profile.select("dataset_name", (F.col("file_no") + 1).alias("file_no"), F.col("name").alias("n"), F.col("types").alias("old_types"), F.col("sketch").alias("old_sketch")).filter(F.col("file_no") <= last)
    c = now.join(before, ["dataset_name", "file_no", "n"], "full_outer")
    old, new = F.col("old_types").isNotNull(), F.col("new_types").isNotNull()
    strange = (
        old
        & new
        & (F.expr("theta_sketch_estimate(old_sketch)") >= DISTINCT)
        & (F.expr("theta_sketch_estimate(new_sketch)") >= DISTINCT)
        & (F.expr("theta_sketch_estimate(theta_intersection(old_sketch, new_sketch))") < STRANGE * F.expr("least(theta_sketch_estimate(old_sketch), theta_sketch_estimate(new_sketch))"))
    )
    strange = F.coalesce(strange, F.lit(False))
    return c.select(
        "dataset_name",
        "file_no",
        F.when(old, F.col("n")).alias("old_name"),
        F.when(new, F.col("n")).alias("new_name"),
        "old_types",
        "new_types",
        (old & (~new | strange)).alias("old_candidate"),
        (new & (~old | strange)).alias("new_candidate"),
    )


def changes(lines: DataFrame, record: str = "record_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(changes, files, fields): ``changes`` has ``dataset_name, source_file, file_no, change_kind, old_name, new_name, old_type, new_type``."""
    files, fields, profile = profiled(lines, record)
    # a dataset's files end at different numbers: nothing is removed by a file that doesn't exist
    compared = cut(compare(profile).join(files.select("dataset_name", "file_no"), ["dataset_name", "file_no"], "left_semi"))
    renamed = cut(renames(fields, compared))
    key = ["dataset_name", "file_no"]
    gone = compared.filter("old_name IS NOT NULL").join(renamed.select(*key, "old_name", F.lit(True).alias("went")), [*key, "old_name"], "left")
    came = compared.filter("new_name IS NOT NULL").join(renamed.select(*key, "new_name", F.lit(True).alias("got")), [*key, "new_name"], "left")
    name = lambda c: F.col(c).alias(c)
    empty = F.lit("")
    shown = ["change_kind", "old_name", "new_name", "old_type", "new_type"]
    parts = [
        # a namesake whose values went on elsewhere was removed only if the new file lacks the name
        gone.filter("went IS NULL AND new_name IS NULL").select(*key, F.lit("removed").alias("change_kind"), name("old_name"), empty.alias("new_name"), F.col("old_types").alias("old_type"), empty.alias("new_type")),
        came.filter("got IS NULL AND old_name IS NULL").select(*key, F.lit("added").alias("change_kind"), empty.alias("old_name"), name("new_name"), empty.alias("old_type"), F.col("new_types").alias("new_type")),
        renamed.join(compared.select(*key, "old_name", "old_types"), [*key, "old_name"]).join(compared.select(*key, "new_name", "new_types"), [*key, "new_name"]).select(*key, F.lit("renamed").alias("change_kind"), "old_name", "new_name", F.col("old_types").alias("old_type"), F.col("new_types").alias("new_type")),
        gone.filter("went IS NULL AND new_name IS NOT NULL AND old_types <> new_types AND old_types <> '' AND new_types <> ''").select(*key, F.lit("type_changed").alias("change_kind"), name("old_name"), name("new_name"), F.col("old_types").alias("old_type"), F.col("new_types").alias("new_type")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.join(files.select(*key, "source_file"), key).select("dataset_name", "source_file", "file_no", *shown), files, fields


def _canonical(pdf: pd.DataFrame) -> pd.DataFrame:
    """Canonical names along the chain of one dataset's renames: the name at the field's first appearance."""
    known: dict[str, str] = {}
    out = []
    for no, group in pdf.sort_values("file_no").groupby("file_no"):
        moved = {n: known.get(o, o) for o, n in zip(group["old_name"], group["new_name"])}
        for o in group["old_name"]:
            known.pop(o, None)
        known.update(moved)
        out += [(pdf["dataset_name"].iloc[0], int(no), n, c) for n, c in known.items()]
    return pd.DataFrame(out, columns=["dataset_name", "from_no", "name", "canonical"])


def canonical_names(change_list: DataFrame) -> DataFrame:
    """``dataset_name, from_no, name, canonical`` after each file with a rename (a list of names, not of records)."""
    moved = change_list.filter("change_kind = 'renamed'").select("dataset_name", "file_no", "old_name", "new_name")
    return moved.groupBy("dataset_name").applyInPandas(_canonical, "dataset_name string, from_no int, name string, canonical string")


def _called(lines: DataFrame, record: str) -> tuple[DataFrame, DataFrame]:
    """(``dataset_name, file_no, rec, called, type, value`` of every field under its canonical name, files)."""
    change_list, files, fields = changes(lines, record)
    names = cut(canonical_names(change_list))
    # the names that hold from the last renaming file up to each file
    steps = names.select("dataset_name", "from_no").distinct()
    latest = files.select("dataset_name", "file_no").join(steps, "dataset_name").filter("from_no <= file_no").groupBy("dataset_name", "file_no").agg(F.max("from_no").alias("from_no"))
    valid = latest.join(names, ["dataset_name", "from_no"]).select("dataset_name", "file_no", "name", "canonical")
    # a new field may bear the name that an older one, renamed since, keeps as canonical
    taken = valid.select("dataset_name", "file_no", F.col("canonical").alias("name"), F.lit(True).alias("taken")).distinct()
    out = fields.join(valid, ["dataset_name", "file_no", "name"], "left").join(taken, ["dataset_name", "file_no", "name"], "left")
    called = F.coalesce("canonical", F.when(F.col("taken"), F.concat("name", F.lit("#2"))).otherwise(F.col("name")))
    return out.select("dataset_name", "file_no", "rec", called.alias("called"), "type", "value"), files


def unified(lines: DataFrame, record: str = "record_id") -> DataFrame:
    """All files as one table: ``dataset_name, source_file, record, fields`` with a map from canonical name to value as text."""
    out, files = _called(lines, record)
    listed = F.array_sort(F.collect_list(F.struct(F.col("called").alias("k"), F.col("value").alias("v"))))
    entries = F.map_from_entries(F.filter(listed, lambda e, i: (i == 0) | (F.get(listed, i - 1)["k"] != e["k"])))
    # one record has a handful of fields: the list is bounded by the payload's own size
    table = out.groupBy("dataset_name", "file_no", "rec").agg(entries.alias("fields"))
    return table.join(files.select("dataset_name", "file_no", "source_file"), ["dataset_name", "file_no"]).select("dataset_name", "source_file", F.col("rec").alias(record), "fields")


def unified_tables(lines: DataFrame, record: str = "record_id") -> dict[str, DataFrame]:
    """One table of typed columns for each dataset: ``dataset_name, source_file, record`` and the fields by canonical name.

    A field's column has the widest JSON type of its values: double or boolean if all are, else text (objects and arrays as
    JSON). Names that differ from an earlier one only by case, or are those of the first three columns, get a number.
    """
    out, files = _called(lines, record)
    out = cut(out)
    kinds = out.filter("type IS NOT NULL").groupBy("dataset_name", "called").agg(F.min("type").alias("a"), F.max("type").alias("b"))
    tables = {}
    # the columns of the tables, which the driver needs to name them: names of fields, not records
    listed = out.select("dataset_name", "called").distinct().join(kinds, ["dataset_name", "called"], "left").orderBy("dataset_name", "called").collect()
    for dataset in dict.fromkeys(r.dataset_name for r in listed):
        used, columns = {"dataset_name", "source_file", record.lower()}, []
        for r in (r for r in listed if r.dataset_name == dataset):
            name, n = r.called, 1
            while name.lower() in used:
                n += 1
                name = f"{r.called}#{n}"
            used.add(name.lower())
            kind = {"number": "double", "boolean": "boolean"}.get(r.a if r.a == r.b else "", "string")
            columns.append(F.max(F.when(F.col("called") == r.called, F.col("value"))).try_cast(kind).alias(name))
        rows = out.filter(F.col("dataset_name") == dataset).groupBy("dataset_name", "file_no", "rec").agg(*columns)
        named = rows.join(files.select("dataset_name", "file_no", "source_file"), ["dataset_name", "file_no"])
        tables[dataset] = named.select("dataset_name", "source_file", F.col("rec").alias(record), *[F.col(f"`{c}`") for c in rows.columns[3:]])
    return tables
