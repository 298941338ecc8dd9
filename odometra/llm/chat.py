r"""Chat formatting by schema fingerprint (operator 10, DataFrame functions only).

Template: <|turn|>ROLE<|text|>TEXT<|end|> for every turn. In roles and texts each of \ < | [
becomes a backslash and a letter, so that neither the template's own control strings nor
those of other templates (</s>, [INST]) can occur inside a text; reading them back is exact.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: The backslash's own code comes first, and is read back last.
CODES = (("\\", "\\s"), ("<", "\\l"), ("|", "\\p"), ("[", "\\b"))


def escape(text: Column) -> Column:
    """Every backslash that this leaves begins one of its codes."""
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a type, arrays as []."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def paths_hash(paths) -> str:
    """fingerprint() of given field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()


def fingerprint(paths: Column) -> Column:
    """Hash of a record's sorted nested field paths."""
    return F.sha2(F.array_join(F.array_sort(F.array_distinct(paths)), "\n").cast("binary"), 256)


NO_TURNS = "array<struct<role:string,text:string>>"


def _turns(*pairs: tuple[str, Column]) -> Column:
    return F.filter(F.array(*[F.struct(F.lit(r).alias("role"), t.alias("text")) for r, t in pairs]), lambda t: t["text"].isNotNull())


def _get(record: Column, path: str, kind: str = "string") -> Column:
    """What a variant has at a path, as a type; null where it is something else."""
    return F.try_variant_get(record, f"$.{path}", kind)


def _elements(value: Column) -> Column:
    """Elements of a variant that is a list; null for all others, strings that look like lists included."""
    return F.when(F.schema_of_variant(value).startswith("ARRAY<"), F.try_variant_get(value, "$", "array<variant>"))


def _list(record: Column, path: str, role: str, text: str, read=None) -> Column:
    said = read or (lambda content: F.try_variant_get(content, "$", "string"))
    return F.transform(
        _elements(_get(record, path, "variant")),
        lambda t: F.struct(F.coalesce(_get(t, role), F.lit("")).alias("role"), F.coalesce(said(_get(t, text, "variant")), F.lit("")).alias("text")),
    )


def _parts(record: Column) -> Column:
    """Messages whose content is a string or a list of parts; texts of the parts are put one after the other."""

    def joined(content: Column) -> Column:
        parts = F.transform(_elements(content), lambda p: _get(p, "text"))
        return F.coalesce(F.array_join(parts, ""), F.try_variant_get(content, "$", "string"))

    return _list(record, "messages", "role", "content", joined)


def _people(record: Column) -> Column:
    named = F.create_map(F.lit("human"), F.lit("user"), F.lit("gpt"), F.lit("assistant"))
    return F.transform(_list(record, "conversations", "from", "value"), lambda t: F.struct(F.coalesce(named[t["role"]], t["role"]).alias("role"), t["text"].alias("text")))


#: Layout by its field paths: how a record of that layout (a variant) becomes turns.
LAYOUTS: dict[tuple[str, ...], object] = {
    ("prompt", "completion"): lambda j: _turns(("user", _get(j, "prompt")), ("assistant", _get(j, "completion"))),
    ("prompt", "response"): lambda j: _turns(("user", _get(j, "prompt")), ("assistant", _get(j, "response"))),
    ("question", "answer"): lambda j: _turns(("user", _get(j, "question")), ("assistant", _get(j, "answer"))),
    ("instruction", "output"): lambda j: _turns(("user", _get(j, "instruction")), ("assistant", _get(j, "output"))),
    ("instruction", "input", "output"): lambda j: _turns(("user", F.concat_ws("\n", _get(j, "instruction"), F.nullif(_get(j, "input"), F.lit("")))), ("assistant", _get(j, "output"))),
    ("system", "prompt", "response"): lambda j: _turns(("system", _get(j, "system")), ("user", _get(j, "prompt")), ("assistant", _get(j, "response"))),
    ("messages[].role", "messages[].content"): lambda j: _list(j, "messages", "role", "content"),
    ("messages[].role", "messages[].content[].text"): _parts,
    ("messages[].role", "messages[].content", "messages[].content[].text"): _parts,
    ("conversations[].from", "conversations[].value"): _people,
}
#: Fields that some layout reads. Others (id, source, tool_calls, ...) aren't hashed: they change no mapping.
KNOWN = tuple(sorted({p for paths in LAYOUTS for p in paths}))
#: Lists in lists that paths are followed into.
DEPTH = 3


#: Code points of a string that the JSON reader takes; its own limit is 20 million.
LONGEST_STRING = 2**31 - 1


def record_of(json: Column) -> Column:
    """JSON as a variant, which keeps strings and lists apart; null where it is broken."""
    return F.from_json(json, "variant", {"maxStringLen": str(LONGEST_STRING)})


def record_paths(record: Column) -> Column:
    """Field paths of a variant: of the records in a list, the union of all of them, as key[].path."""

    def below(value: Column, at: Column | None, depth: int) -> Column:
        def of(entry: Column) -> Column:
            path = entry["key"] if at is None else F.concat(at, entry["key"])
            if depth == 1:
                return F.array(path)
            listed = F.filter(_elements(entry["value"]), lambda x: F.schema_of_variant(x).startswith("OBJECT<"))
            return F.when(F.size(listed) > 0, F.array_distinct(F.flatten(F.transform(listed, lambda x: below(x, F.concat(path, F.lit("[].")), depth - 1))))).otherwise(F.array(path))

        fields = F.try_variant_get(value, "$", "map<string,variant>")
        return F.coalesce(F.flatten(F.transform(F.map_entries(fields), of)), F.array().cast("array<string>"))

    return F.array_distinct(below(record, None, DEPTH))


def canonical_turns(records: DataFrame, *, id_col: str, json_col: str) -> DataFrame:
    """(conv_id, layout, turns) of JSON records in any registered layout.

    The hash of a record's nested field paths, as far as any layout knows them, selects its
    mapping. A record without such fields, or with a mixture that no layout has, null and
    broken JSON give no turns and layout null; they are never dropped. A string is a text
    whatever it looks like: only lists in the JSON itself are lists.
    """
    out = records.select(F.col(id_col).alias("conv_id"), record_of(F.col(json_col).cast("string")).alias("record"))
    known = F.array(*[F.lit(p) for p in KNOWN])
    out = out.withColumn("print", fingerprint(F.array_intersect(record_paths(F.col("record")), known)))
    turns, layout = F.lit(None).cast(NO_TURNS), F.lit(None).cast("string")
    for paths, mapping in LAYOUTS.items():
        same = F.col("print") == paths_hash(paths)
        turns = F.when(same, mapping(F.col("record"))).otherwise(turns)
        layout = F.when(same, F.lit("+".join(paths))).otherwise(layout)
    return out.select("conv_id", layout.alias("layout"), F.coalesce(turns, F.array().cast(NO_TURNS)).alias("turns"))


#: Layout of tables with a row a turn: field paths to (conversation, order, role, text).
ROW_LAYOUTS: dict[tuple[str, ...], tuple[str, str, str, str]] = {
    ("conv_id", "turn", "role", "text"): ("conv_id", "turn", "role", "text"),
    ("conversation_id", "position", "speaker", "utterance"): ("conversation_id", "position", "speaker", "utterance"),
}


def row_layout(rows: DataFrame) -> tuple[str, str, str, str]:
    """Columns (conversation, order, role, text): the hash of the table's field paths, as far as a layout knows them, selects the mapping."""
    have = set(field_paths(rows.schema))
    by_print = {paths_hash(paths): names for paths, names in ROW_LAYOUTS.items()}
    for paths in ROW_LAYOUTS:
        if (names := by_print.get(paths_hash(have.intersection(paths)))) is not None:
            return names
    raise ValueError(f"no layout has the fields {sorted(have)}")


def row_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) of a table with a row a turn; its fields are typed, so no text is read as anything else.

    The hash of the table's field paths selects the mapping; columns beyond a layout's own are
    ignored. Turns are ordered by turn (null first), then role and text; null role and text
    count as empty; repeated rows are turns of their own. A conversation is one output text,
    so its turns meet in one row; conversations are spread over tasks by their id.
    """
    names = row_layout(rows)
    conv, turn, role, text = (F.col(f"`{n}`") for n in names)
    one = F.struct(turn.alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    got = rows.groupBy(conv.alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("t"))
    nulls_first = F.concat(F.filter("t", lambda t: t["turn"].isNull()), F.filter("t", lambda t: t["turn"].isNotNull()))
    return got.select("conv_id", F.transform(nulls_first, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def render(turns: DataFrame, *, train_on: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_lengths) of (conv_id, turns).

    loss_lengths has a number for each turn: code points of its escaped text under the loss
    mask, 0 where the role isn't train_on. Offsets follow from the template.
    """
    shown = F.transform("turns", lambda t: F.concat(F.lit(TURN), escape(t["role"]), F.lit(TEXT), escape(t["text"]), F.lit(END)))
    masked = F.transform("turns", lambda t: F.when(t["role"] == train_on, F.length(escape(t["text"]))).otherwise(0))
    return turns.select("conv_id", F.array_join(shown, "").alias("formatted"), masked.alias("loss_lengths"))


def parse(formatted: DataFrame, *, train_on: str = "assistant") -> DataFrame:
    """Read turns and the text under the loss mask back from formatted strings alone."""
    segments = F.expr(r"slice(split(formatted, '<[|]turn[|]>'), 2, 2147483646)")
    cut = F.transform(segments, lambda s: F.split(F.regexp_replace(s, r"<[|]end[|]>$", ""), r"<[|]text[|]>"))
    turns = F.transform(cut, lambda c: F.struct(unescape(F.get(c, F.lit(0))).alias("role"), unescape(F.get(c, F.lit(1))).alias("text")))
    out = formatted.select("conv_id", "formatted", F.when(F.col("formatted") == "", F.array().cast("array<struct<role:string,text:string>>")).otherwise(turns).alias("turns"))
    return out.withColumn("loss_text", F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == train_on), lambda t: t["text"]), ""))


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations")
    rows = rows.select(*row_layout(rows)).toDF("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    back = parse(render(row_turns(rows.unionByName(extra))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        sha(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(8 + 8 + 7 + length(regexp_replace(role, '([\\|<\[])', '\\\1', 'g')) + length(regexp_replace(text, '([\\|<\[])', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
