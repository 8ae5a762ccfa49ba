"""The document-path language, compiled once on the driver to a Column.

A path is ``/``-separated steps walked from a document row:

* ``schema:field`` (full match of ``[a-zA-Z_:][\\w\\-:]*:[a-zA-Z_:][\\w\\-:]*``)
  reads a property; allowed only at the document or on ``properties``;
* ``properties`` is the property map; ``.`` the document itself;
* any other name at the document is an entity column (``id``, ``name``,
  ``state``, ``locked`` …), null when the document has no such column;
* below a property a name step reads an object member;
* an integer step indexes an array, **1-based**; ``-k`` becomes
  ``len - k`` (still 1-based, so ``-1`` is the second to last); an index
  below 0 or above ``len`` is an error; index 0 matches nothing;
* ``[member op literal]`` keeps the array elements that satisfy it.

A step that matches several values yields a list; a list with no match
is null, with one match the bare value (leading nulls are dropped).

Properties are ``MAP<STRING, VARIANT>``; the compiled value of a property
path is a VARIANT column (:func:`render` turns it into attribute text).
Compilation raises ``ValueError`` for invalid paths before any job runs;
data-dependent errors (index out of range) come back as an error column,
so one bad row fails alone instead of failing the job.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentlake.functions.values import variant_to_text

# fixed value: the property-step pattern of the path language
SCHEMA_STEP = re.compile(r"[a-zA-Z_:][\w\-:]*:[a-zA-Z_:][\w\-:]*", re.ASCII)
_INT = re.compile(r"[+-]?\d+", re.ASCII)
_PRED = re.compile(r"\[\s*([A-Za-z_][\w\-:]*|\.)\s*(>=|<=|!=|=|>|<)\s*(.+?)\s*\]", re.ASCII)
_NUMBER = re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?", re.ASCII)
OUT_OF_RANGE = "no array element at this index"
MOST_ELEMENTS = (1 << 31) - 1   # of an array: an index beyond is out of range whatever its length


@dataclass(frozen=True)
class Step:
    kind: str            # prop | name | self | index | pred
    text: str
    index: int = 0
    member: str = ""
    op: str = ""
    literal: object = None


def parse(path: str | None) -> list[Step] | None:
    """Split a path into steps. ``None`` for a blank path (evaluates to null)."""
    if path is None:
        raise ValueError("missing path")
    if path.strip() == "":
        return None
    steps: list[Step] = []
    # one slash before the first and one behind the last step belong to no step
    for part in path.removeprefix("/").removesuffix("/").split("/"):
        if part == "":
            raise ValueError(f"empty step in path {path!r}")
        if part.startswith("[") != part.endswith("]"):
            raise ValueError(f"unbalanced predicate step {part!r} in {path!r} "
                             "('/' cannot appear inside a predicate)")
        if SCHEMA_STEP.fullmatch(part):
            steps.append(Step("prop", part))
        elif part == ".":
            steps.append(Step("self", part))
        elif _INT.fullmatch(part):
            steps.append(Step("index", part, index=max(-MOST_ELEMENTS, min(MOST_ELEMENTS, int(part)))))
        elif part.startswith("["):
            m = _PRED.fullmatch(part)
            if not m:
                raise ValueError(f"unsupported predicate {part!r}")
            lit_text = m.group(3)
            if lit_text[:1] in "'\"" and lit_text[-1:] == lit_text[:1]:
                literal: object = lit_text[1:-1]
            else:
                if not _NUMBER.fullmatch(lit_text):
                    raise ValueError(f"bad literal in predicate {part!r}")
                literal = float(lit_text) if any(c in lit_text for c in ".eE") else int(lit_text)
            steps.append(Step("pred", part, member=m.group(1), op=m.group(2), literal=literal))
        else:
            steps.append(Step("name", part))
    return steps


def _json_key(name: str) -> str:
    return '$["' + name.replace('"', '\\"') + '"]'


def _as_array(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def _compare(x: Column, op: str, lit: object) -> Column:
    ops = {">": x.__gt__, "<": x.__lt__, ">=": x.__ge__, "<=": x.__le__,
           "=": x.__eq__, "!=": x.__ne__}
    return ops[op](F.lit(lit))


def _pred_value(x: Column, step: Step) -> Column:
    target = x if step.member == "." else F.try_variant_get(x, _json_key(step.member), "variant")
    typ = "string" if isinstance(step.literal, str) else "double"
    return F.try_variant_get(target, "$", typ)


def _predicate(step: Step):
    # F.filter inspects the lambda's arity, so bind the step in a closure
    return lambda x: _compare(_pred_value(x, step), step.op, step.literal)


def collapse(matches: Column) -> Column:
    """List of matches -> null (none), the value (one), or a list (several).

    Nulls before the first non-null value are dropped, as long as a later
    value follows; later nulls are kept.
    """
    n = F.size(matches)
    head = F.slice(matches, 1, F.greatest(n - 1, F.lit(1)))
    first_nn = F.array_min(F.filter(
        F.transform(head, lambda x, i: F.when(~F.isnull(x) & ~F.is_variant_null(x), i + 1)),
        lambda y: y.isNotNull()))
    trimmed = F.when(first_nn.isNull(), F.slice(matches, n, 1)) \
               .otherwise(F.slice(matches, first_nn, n))
    m = F.size(trimmed)
    return (F.when(matches.isNull() | (n == 0), F.lit(None).cast("variant"))
             .when(m == 1, F.element_at(trimmed, 1))
             .otherwise(trimmed.cast("variant")))


@dataclass
class Compiled:
    value: Column        # VARIANT, or a typed column for entity fields
    error: Column        # null, or the error text for that row
    kind: str            # variant | field | doc | null


def compile_path(path: str | None, doc_columns: list[str] | None = None,
                 properties: str = "properties") -> Compiled:
    """Compile ``path`` against a docs frame with the given columns."""
    steps = parse(path)
    no_error = F.lit(None).cast("string")
    if steps is None:
        return Compiled(F.lit(None), no_error, "null")
    cols = [c for c in (doc_columns or []) if c != properties]
    ctx = "doc"
    cur: Column | None = None
    many = False                      # cur holds a list of matches
    err = no_error
    for st in steps:
        if ctx == "null":
            break
        if st.kind == "prop":
            if ctx not in ("doc", "props"):
                raise ValueError(f"property step {st.text!r} below a value")
            cur, ctx = F.try_element_at(F.col(properties), F.lit(st.text)), "variant"
        elif ctx == "doc":
            if st.kind == "self":
                cur, ctx = F.struct(*[F.col(c) for c in cols]), "doc_value"
            elif st.kind == "name" and st.text == properties:
                cur, ctx = F.col(properties), "props"
            elif st.kind == "name" and st.text in cols:
                cur, ctx = F.col(st.text), "field"
            else:
                cur, ctx = F.lit(None), "null"
        elif ctx == "props":
            if st.kind == "name":
                cur, ctx = F.try_element_at(F.col(properties), F.lit(st.text)), "variant"
            else:
                cur, ctx = F.lit(None), "null"
        elif ctx == "variant":
            if st.kind == "name":
                if many:
                    key = _json_key(st.text)
                    cur = F.filter(F.transform(cur, lambda x: F.try_variant_get(x, key, "variant")),
                                   lambda y: y.isNotNull())
                else:
                    cur = F.try_variant_get(cur, _json_key(st.text), "variant")
            elif st.kind == "index" and not many:
                arr = _as_array(cur)
                n = F.size(arr)
                if st.index < 0:
                    idx = n + F.lit(st.index)
                    bad = arr.isNotNull() & ((idx < 0) | (idx > n))
                    zero = idx == 0
                else:                  # literal index: range and zero known here
                    idx = F.lit(max(st.index, 1))
                    bad = arr.isNotNull() & (F.lit(st.index) > n)
                    zero = F.lit(st.index == 0)
                err = F.when(err.isNotNull(), err).when(bad, F.lit(OUT_OF_RANGE))
                cur = F.when(arr.isNull() | bad | zero, F.lit(None).cast("variant")) \
                       .otherwise(F.try_element_at(arr, F.greatest(idx, F.lit(1))))
            elif st.kind == "pred" and not many:
                arr = _as_array(cur)
                cur = F.filter(arr, _predicate(st))
                many = True
            else:
                cur, ctx = F.lit(None), "null"
        else:                          # field / doc_value: scalars have no members
            cur, ctx = F.lit(None), "null"
    if many:
        cur = collapse(cur)
    kind = {"variant": "variant", "field": "field", "doc_value": "doc", "props": "props"}.get(ctx, "null")
    return Compiled(cur, err, kind)


def render(c: Compiled) -> Column:
    """Attribute text of a compiled path value."""
    if c.kind == "variant":
        return variant_to_text(c.value)
    if c.kind in ("doc", "props"):
        return F.to_json(c.value)
    if c.kind == "field":
        return c.value.cast("string")
    return F.lit(None).cast("string")


def evaluate(path: str | None, doc_columns: list[str], properties: str = "properties") -> Column:
    """Attribute text of ``path`` for each document row."""
    return render(compile_path(path, doc_columns, properties))


# ---- paths whose text differs from row to row

_STEP_ERRORS = (
    (lambda p: p == "", "empty step in path"),
    (lambda p: p.startswith("[") != p.endswith("]"), "unbalanced predicate step"),
    (lambda p: p.startswith("[") & ~p.rlike(f"^{_PRED.pattern}$"), "unsupported predicate"),
    (lambda p: p.startswith("[") & p.rlike(f"^{_PRED.pattern}$") & ~_quoted(_literal(p))
     & ~_literal(p).rlike(f"^(?:{_NUMBER.pattern})$"), "bad literal in predicate"),
)


def _literal(p: Column) -> Column:
    return F.regexp_extract(p, f"^{_PRED.pattern}$", 3)


def _quoted(literal: Column) -> Column:
    return literal.rlike("^'.*'$") | literal.rlike('^".*"$')


def _key(name: Column) -> Column:
    return F.concat(F.lit('$["'), F.replace(name, F.lit('"'), F.lit('\\"')), F.lit('"]'))


def _matches_predicate(x: Column, step: Column) -> Column:
    member, op = (F.regexp_extract(step, f"^{_PRED.pattern}$", g) for g in (1, 2))
    literal = _literal(step)
    target = F.when(member == ".", x).otherwise(F.try_variant_get(x, _key(member), "variant"))
    text, number = F.try_variant_get(target, "$", "string"), F.try_variant_get(target, "$", "double")
    inner, value = literal.substr(F.lit(2), F.length(literal) - 2), literal.try_cast("double")

    def compared(a: Column, b: Column) -> Column:
        return (F.when(op == ">", a > b).when(op == "<", a < b).when(op == ">=", a >= b)
                 .when(op == "<=", a <= b).when(op == "=", a == b).otherwise(a != b))

    return F.when(_quoted(literal), compared(text, inner)).otherwise(compared(number, value))


def _take_step(state: Column, step: Column) -> Column:
    """One step: ``m`` the matches so far (one value unless ``many``), ``err``."""
    null, first = F.lit(None).cast("variant"), F.try_element_at(state["m"], F.lit(1))
    is_index, is_pred = step.rlike(f"^{_INT.pattern}$"), step.startswith("[")
    arr = _as_array(first)
    n, k = F.size(arr), step.try_cast("bigint")   # null: longer than any array
    idx = F.when(k < 0, n + k).otherwise(k)
    bad = is_index & ~state["many"] & arr.isNotNull() & (k.isNull() | (idx < 0) | (idx > n))
    named = F.transform(state["m"], lambda x: F.try_variant_get(x, _key(step), "variant"))
    m = (F.when((is_index | is_pred) & state["many"], F.array(null))
          .when(is_pred, F.filter(arr, lambda x: _matches_predicate(x, step)))
          .when(is_index, F.array(F.when(arr.isNull() | bad | (idx == 0), null)
                                   .otherwise(F.try_element_at(arr, F.greatest(idx, F.lit(1)).try_cast("int")))))
          .when(step == ".", F.array(null))
          .when(state["many"], F.filter(named, lambda y: y.isNotNull()))
          .otherwise(named))
    many = (state["many"] | is_pred) & ~((is_index | is_pred) & state["many"]) & ~(step == ".")
    err = F.coalesce(state["err"], F.when(bad, F.lit(OUT_OF_RANGE)))
    return F.struct(m.alias("m"), many.alias("many"), err.alias("err"))


def evaluate_per_row(docs: DataFrame, path: Column, value_col: str, error_col: str,
                     doc_columns: list[str] | None = None, properties: str = "properties") -> DataFrame:
    """``docs`` with the attribute text (``value_col``) and error (``error_col``)
    of a path text that may differ in every row.

    The same rules as :func:`compile_path`, as one expression over the array of
    steps: the plan doesn't grow with the number of texts, and none of them is
    looked at on the driver. An invalid text is an error of its row, a blank
    one gives null, and so does a null one."""
    cols = [c for c in (doc_columns or docs.columns) if c != properties]
    schema = f"^{SCHEMA_STEP.pattern}$"
    # named step by step, so that each part is computed once per row
    df = docs.withColumn("_text", path)
    bare = F.regexp_replace(F.regexp_replace("_text", "^/", ""), "/$", "")
    df = df.withColumn("_parts", F.split(bare, "/"))
    parts, size = F.col("_parts"), F.size("_parts")
    first, second = parts[0], F.try_element_at(parts, F.lit(2))
    behind = lambda n: F.slice(parts, n + 1, F.greatest(size - n, F.lit(0)))
    df = df.withColumn("_kind", F.when(first.rlike(schema), "prop").when((first == properties) & second.isNotNull(), "props")
                       .when(first == properties, "map").when(first == ".", "self")
                       .when(first.isin(cols) if cols else F.lit(False), "field").otherwise("none"))
    kind = F.col("_kind")
    df = df.withColumn("_rest", F.when(kind == "prop", behind(1)).when(kind == "props", behind(2))
                       .when(kind.isin("self", "field"), behind(1)).otherwise(F.array().cast("array<string>")))
    invalid = F.lit(None).cast("string")
    for wrong, what in _STEP_ERRORS:
        invalid = F.coalesce(invalid, F.when(F.exists(parts, wrong), F.concat(F.lit(f"{what}: "), F.col("_text"))))
    below = F.exists("_rest", lambda p: p.rlike(schema))
    invalid = F.coalesce(invalid, F.when(below, F.concat(F.lit("property step below a value: "), F.col("_text"))))
    df = df.withColumn("_invalid", F.when(F.trim("_text") != "", invalid))
    evaluated = kind.isin("prop", "props") & F.col("_invalid").isNull()
    root = F.try_element_at(F.col(properties), F.when(kind == "prop", first).otherwise(second))
    start = F.struct(F.array(root).alias("m"), F.lit(False).alias("many"), F.lit(None).cast("string").alias("err"))
    df = df.withColumn("_end", F.when(evaluated, F.aggregate("_rest", start, _take_step)))
    end = F.col("_end")
    df = df.withColumn("_value", F.when(end["many"], collapse(end["m"])).otherwise(F.try_element_at(end["m"], F.lit(1))))
    text = F.when(evaluated, variant_to_text(F.col("_value"))).when(kind == "map", F.to_json(F.col(properties)))
    alone = size == 1
    text = text.when((kind == "self") & alone, F.to_json(F.struct(*[F.col(c) for c in cols])))
    for c in cols:  # entity fields are scalars
        text = text.when((kind == "field") & alone & (first == c), F.col(c).cast("string"))
    return df.withColumns({
        value_col: F.when((F.trim("_text") != "") & F.col("_invalid").isNull(), text),
        error_col: F.coalesce("_invalid", end["err"])}).drop(
            "_text", "_parts", "_kind", "_rest", "_invalid", "_end", "_value")
