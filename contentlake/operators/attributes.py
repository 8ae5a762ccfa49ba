"""Document -> attributes (flattening) and array properties in long form.

``document_to_columns`` is one ``select``: every mapped path is compiled
once on the driver and evaluated in whole-stage codegen; nothing per row
runs in Python.

Array properties stored as child tables (``doc_id, pos, <members>``, one
row per element) are walked with :func:`element_path`: index steps become
``pos`` filters, predicates become row filters, and the null / value /
list collapse is a per-document count with the list in numbered chunks. No
document's elements are ever gathered into one row, so a huge array does not
land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from contentlake.functions import paths
from contentlake.functions.values import include_schemas, variant_to_text
from contentlake.operators.routing import FAILURE, SUCCESS


def document_to_columns_all(docs: DataFrame, schemas: list[str] | None = None,
                            id_col: str = "id", properties: str = "properties") -> DataFrame:
    """No mapping: every non-null property becomes an attribute (long form:
    ``doc_id, key, value``)."""
    props = include_schemas(F.col(properties), schemas)
    return (docs.select(F.col(id_col).alias("doc_id"), F.explode(props).alias("key", "v"))
                .where(F.col("v").isNotNull() & ~F.is_variant_null("v"))
                .select("doc_id", "key", variant_to_text(F.col("v")).alias("value")))


def document_to_columns(docs: DataFrame, mapping: dict[str, str], keep: list[str] | None = None,
                        properties: str = "properties", nulls: Observation | None = None) -> DataFrame:
    """Mapping ``attribute -> path``: one column per attribute (null when the
    path yields nothing), plus ``route``/``error`` when a path fails on a row
    (e.g. an array index out of range).

    The host warns about an attribute whose path yields nothing; here ``nulls``, an
    ``Observation``, counts them per attribute (and the ``documents``) in the pass that
    writes the rows: ``nulls.get`` has the counts after the first action."""
    keep = keep if keep is not None else ["id"]
    cols = docs.columns
    compiled = {name: paths.compile_path(p, cols, properties) for name, p in mapping.items()}
    errors = [c.error for c in compiled.values()]
    err = F.coalesce(*errors) if errors else F.lit(None).cast("string")
    out = docs.select(
        *[F.col(k) for k in keep],
        *[paths.render(c).alias(name) for name, c in compiled.items()],
        F.when(err.isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("route"),
        err.alias("error"))
    if nulls is None:
        return out
    return out.observe(nulls, F.count(F.lit(1)).alias("documents"), *[F.count_if(F.col(name).isNull()).alias(name) for name in compiled])


def entity_stamp(out: DataFrame, id_col: str = "id", entity: Column | str = "document") -> DataFrame:
    """Every row of an operator's output with ``entity`` and ``docid`` (the
    reference's ``nx-entity`` and ``nx-docid``), replacing columns of these
    names. A row without document has neither."""
    kind = entity if isinstance(entity, Column) else F.lit(entity)
    here = F.col(id_col).isNotNull()
    return out.withColumns({"entity": F.when(here, kind), "docid": F.col(id_col).cast("string")})


def element_path(elements: DataFrame, path: str, doc_col: str = "doc_id",
                 pos_col: str = "pos") -> DataFrame:
    """Evaluate the steps after an array property on its long-form table.

    ``path`` starts with the array property (``files:files/2/name``). The
    result has one row per match: ``doc_id, pos, value`` (``value`` is the
    selected member, or a JSON text of the element when no member step
    follows), plus ``error`` rows for out-of-range indexes.
    """
    steps = paths.parse(path)
    if not steps or steps[0].kind != "prop":
        raise ValueError("element paths start with the array property")
    members = [c for c in elements.columns if c not in (doc_col, pos_col)]
    cur = elements
    member: str | None = None
    err_rows: DataFrame | None = None
    for st in steps[1:]:
        if member is not None:
            raise ValueError(f"step {st.text!r} below the scalar member {member!r}")
        if st.kind == "index":
            k = st.index
            if k >= 0:
                cur = cur.where(F.col(pos_col) == F.lit(k))
                if k > 0:
                    sizes = elements.groupBy(doc_col).agg(F.count(F.lit(1)).alias("_n"))
                    err_rows = sizes.where(F.col("_n") < k).select(
                        doc_col, F.lit(paths.OUT_OF_RANGE).alias("error"))
            else:
                # len + k (1-based): needs the element count of each document,
                # a partial-aggregated count, then a key join
                sizes = elements.groupBy(doc_col).agg(F.count(F.lit(1)).alias("_n"))
                err_rows = sizes.where(F.col("_n") + F.lit(k) < 0).select(
                    doc_col, F.lit(paths.OUT_OF_RANGE).alias("error"))
                cur = (cur.join(sizes, doc_col)
                          .where(F.col(pos_col) == F.col("_n") + F.lit(k))
                          .drop("_n"))
        elif st.kind == "pred":
            target = F.col(st.member)
            cur = cur.where(paths._compare(target, st.op, st.literal))
        elif st.kind == "name":
            if st.text not in members:
                cur = cur.where(F.lit(False))
            member = st.text
        else:
            raise ValueError(f"unsupported element step {st.text!r}")
    value = F.col(member).cast("string") if member else F.to_json(F.struct(*members))
    out = cur.select(doc_col, pos_col, value.alias("value"))
    if err_rows is not None:
        out = out.unionByName(err_rows, allowMissingColumns=True)
    return out


#: Element positions that one row of a collapsed list covers.
LIST_CHUNK = 1000


def collapse_matches(doc_ids: DataFrame, matches: DataFrame, doc_col: str = "doc_id", pos_col: str = "pos",
                     chunk: int = LIST_CHUNK) -> tuple[DataFrame, DataFrame]:
    """The null / value / list collapse of each document's matches, in two parts.

    * per document: ``kind`` (null / value / list), ``n_matches`` and the single value
      when there is exactly one match;
    * the lists: ``doc_id, chunk, n_values, list_value`` (JSON, in order), where chunk c
      holds the matches at element positions c * chunk + 1 to (c + 1) * chunk. Numbers
      ascend and may skip.

    Nulls before the first value are dropped; later ones count and stay in the list.
    Everything is reduced per (document, chunk) first, at most ``chunk`` elements each,
    so a document with very many elements is spread over as many tasks as it has
    chunks; per document only one short row a chunk is left."""
    element = F.struct(F.col(pos_col).cast("long").alias("p"), F.col("value").alias("v"))
    parts = (matches.groupBy(doc_col, F.floor((F.col(pos_col) - 1) / chunk).cast("long").alias("chunk"))
                    .agg(F.array_sort(F.collect_list(element)).alias("_e"),
                         F.min(F.when(F.col("value").isNotNull(), F.col(pos_col).cast("long"))).alias("_p")))
    first = parts.groupBy(doc_col).agg(F.min("_p").alias("_first"))
    parts = parts.join(first, doc_col).withColumn("_e", F.filter("_e", lambda m: m["p"] >= F.col("_first")))
    n = F.size("_e")
    parts = parts.where(n > 0).select(doc_col, "chunk", n.cast("long").alias("n_values"), F.transform("_e", lambda m: m["v"]).alias("_v"))
    counts = parts.groupBy(doc_col).agg(F.sum("n_values").alias("_n"), F.min_by(F.col("_v")[0], "chunk").alias("_one"))
    out = doc_ids.select(doc_col).join(counts, doc_col, "left")
    total = F.coalesce("_n", F.lit(0))
    out = out.select(doc_col, F.when(total == 0, "null").when(total == 1, "value").otherwise("list").alias("kind"),
                     total.alias("n_matches"), F.when(total == 1, F.col("_one")).alias("single_value"))
    several = counts.where("_n > 1").select(doc_col)
    lists = parts.join(several, doc_col, "left_semi").select(doc_col, "chunk", "n_values", F.to_json("_v").alias("list_value"))
    return out, lists


def document_to_columns_templated(docs: DataFrame, mapping: dict[str, Column],
                                  keep: list[str] | None = None,
                                  properties: str = "properties") -> DataFrame:
    """Mapping ``attribute -> path`` where the path text itself varies per row
    (a template rendered from the record, e.g. ``${nx-prop}``).

    Every row's text is split into steps and evaluated in place, however many
    distinct texts there are; a null path text gives null. Invalid path texts
    and array indexes out of range fail those rows only."""
    keep = keep if keep is not None else ["id"]
    cols, errors = docs.columns, []
    for i, (name, path_col) in enumerate(mapping.items()):
        docs = paths.evaluate_per_row(docs, path_col, f"_v{i}", f"_e{i}", cols, properties)
        errors.append(F.col(f"_e{i}"))
    err = F.coalesce(*errors) if errors else F.lit(None).cast("string")
    return docs.select(*[F.col(k) for k in keep], *[F.col(f"_v{i}").alias(name) for i, name in enumerate(mapping)],
                       F.when(err.isNull(), F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("route"),
                       err.alias("error"))
