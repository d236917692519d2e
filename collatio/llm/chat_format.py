"""Chat formatting by schema fingerprints, in DataFrame functions only.

A record's nested field paths are hashed; the hashes select a declarative mapping that turns the record into canonical
turns. The template writes a turn as `<|turn|>role\\ntext<|end|>`. Inside roles and texts `&`, `<` and `[`, and new
lines in roles, are written as character references, so no text can hold a marker of this template, nor one of the usual bracketed or angled ones,
and reading back undoes it exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from collatio.llm.shared import unused

TURN, END = "<|turn|>", "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))
#: Roles end at the first new line, so theirs are written as references too.
ROLE_ESCAPES = (*ESCAPES, ("\n", "&#10;"))
#: Turns of a conversation that are gathered in one array; longer conversations are put together from such blocks.
BLOCK = 256


@dataclass(frozen=True)
class Layout:
    """How records that have all the paths of one of `examples` become turns; other paths that they have don't count.

    Each (role, fields) pair of `turns` gives a turn of the fields' texts, joined by a blank line, empty ones left out; a
    role that starts with $ is a field itself. Then come the turns of the list in the field `listed`, if any.
    """

    name: str
    examples: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    listed: str | None = None
    role_field: str = "role"
    text_field: str = "content"


#: What other tools call the three roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "prompter": "user"}

_SYSTEM = ("system", ("system",))
LAYOUTS = (
    Layout("turn", ('{"role":"","text":""}',), (("$role", ("text",)),)),
    Layout("messages", ('{"messages":[{"role":"","content":""}]}', '{"messages":[]}'), listed="messages"),
    Layout("system_messages", ('{"system":"","messages":[{"role":"","content":""}]}', '{"system":"","messages":[]}'), (_SYSTEM,), "messages"),
    Layout("conversations", ('{"conversations":[{"from":"","value":""}]}', '{"conversations":[]}'), (), "conversations", "from", "value"),
    Layout("system_conversations", ('{"system":"","conversations":[{"from":"","value":""}]}', '{"system":"","conversations":[]}'), (_SYSTEM,), "conversations", "from", "value"),
    Layout("prompt", ('{"prompt":"","completion":""}',), (("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("prompt_response", ('{"prompt":"","response":""}',), (("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question", ('{"question":"","answer":""}',), (("user", ("question",)), ("assistant", ("answer",)))),
    Layout("instruction", ('{"instruction":"","output":""}',), (("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("instruction_input", ('{"instruction":"","input":"","output":""}',), (("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("system_instruction", ('{"system":"","instruction":"","output":""}',), (_SYSTEM, ("user", ("instruction",)), ("assistant", ("output",)))),
    Layout("system_instruction_input", ('{"system":"","instruction":"","input":"","output":""}',), (_SYSTEM, ("user", ("instruction", "input")), ("assistant", ("output",)))),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value being computed once: a plain column that others name often is written into each of them when a filter moves."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _fields(value: Column) -> Column:
    """An object's fields by name; null for anything else."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _names(fields: Column) -> Column:
    """Names of fields, special signs written so that no path has two readings."""
    return F.transform(F.coalesce(F.map_keys(fields), F.array().cast("array<string>")), lambda n: F.regexp_replace(n, r"([\\\[.])", r"\\$1"))


def paths(fields: Column) -> Column:
    """Nested field paths of an object: `a`, and for lists `a[]` with `a[].b` for each field that all elements have, or `a[empty]`.

    Values don't count, so a null or a number in a field changes nothing.
    """
    values = F.map_values(fields)

    def of(name: Column, i: Column) -> Column:
        items = F.try_variant_get(F.get(values, i), "$", "array<variant>")
        names = F.transform(items, lambda x: _names(_fields(x)))
        common = F.aggregate(names, F.get(names, F.lit(0)), F.array_intersect)
        inside = F.transform(common, lambda k: F.concat(name, F.lit("[]."), k))
        return F.when(items.isNull(), F.array(name)).when(F.size(items) == 0, F.array(name, F.concat(name, F.lit("[empty]")))).otherwise(F.concat(F.array(name, F.concat(name, F.lit("[]"))), inside))

    return F.flatten(F.transform(_names(fields), of))


def fingerprint(fields: Column) -> Column:
    """Hashes of an object's nested field paths, each once, in order."""
    return F.array_sort(F.array_distinct(F.transform(paths(fields), lambda p: F.xxhash64(p))))


def _text(value: Column) -> Column:
    """A variant's text; of a list of parts the texts of its strings and of the `text` fields of its objects, joined by a blank line."""
    parts = F.try_variant_get(value, "$", "array<variant>")
    texts = F.transform(parts, lambda x: F.when(_fields(x).isNotNull(), F.try_variant_get(x, "$.text", "string")).otherwise(F.try_variant_get(x, "$", "string")))
    joined = F.array_join(F.filter(texts, lambda x: F.coalesce(x, F.lit("")) != ""), "\n\n")
    return F.coalesce(F.when(parts.isNotNull(), joined).otherwise(F.try_variant_get(value, "$", "string")), F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.alias("role"), text.alias("text"))


def _mapping(layout: Layout) -> Column:
    """A layout's mapping as a value, so that one expression carries out whichever mapping a record has."""
    turns = F.array(*[F.struct(F.lit(role).alias("role"), F.array(*map(F.lit, names)).alias("names")) for role, names in layout.turns]) if layout.turns else F.array()
    listed = F.lit(layout.listed).cast("string").alias("listed"), F.lit(layout.role_field).alias("role_field"), F.lit(layout.text_field).alias("text_field")
    return F.struct(F.lit(layout.name).alias("name"), turns.cast("array<struct<role:string,names:array<string>>>").alias("turns"), *listed)


def _mapped(fields: Column, mapping: Column) -> Column:
    def whole(turn: Column) -> Column:
        texts = F.transform(turn["names"], lambda n: _text(F.try_element_at(fields, n)))
        role = F.when(turn["role"].startswith("$"), _text(F.try_element_at(fields, F.substr(turn["role"], F.lit(2))))).otherwise(turn["role"])
        return _turn(role, F.array_join(F.filter(texts, lambda x: x != ""), "\n\n"))

    items = F.try_variant_get(F.try_element_at(fields, mapping["listed"]), "$", "array<variant>")
    listed = F.transform(F.transform(items, _fields), lambda m: _turn(_text(F.try_element_at(m, mapping["role_field"])), _text(F.try_element_at(m, mapping["text_field"]))))
    turns = F.concat(F.transform(mapping["turns"], whole), F.coalesce(listed, F.array().cast("array<struct<role:string,text:string>>")))
    roles = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    return F.transform(turns, lambda t: _turn(F.coalesce(roles[t["role"]], t["role"]), t["text"]))


def canonical_turns(records: DataFrame, record: str, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """records with `layout` and `turns` (array of role and text) in place of their variant column.

    The hashes of a record's paths select the layout: one of whose examples it has all paths; where several fit, the one
    whose example has the most, then the first. So further fields (ids, weights) change nothing, and a list whose elements
    differ fits only by what all of them have. A record that no layout fits keeps layout and turns null: nothing is guessed
    and no row is lost. Null roles and texts read as empty, an empty list gives no turns, parts without text (images) are
    left out; a null record fits no layout. Columns of records that are called layout or turns give way to the new ones;
    all others stay.
    """
    records = records.drop(*({"layout", "turns"} - {record}))
    (both,) = unused(records, "both")
    shapes = [(layout, example) for layout in layouts for example in layout.examples]
    prints = records.sparkSession.range(1).select(*[fingerprint(_fields(F.parse_json(F.lit(e)))).alias(str(i)) for i, (_, e) in enumerate(shapes)]).first()
    ranked = sorted(zip(shapes, prints, strict=True), key=lambda x: -len(x[1]))

    def chosen(printed: Column) -> Column:
        found = F
        for (layout, _), wanted in ranked:
            found = found.when(F.size(F.array_except(F.array(*map(F.lit, wanted)), printed)) == 0, _mapping(layout))
        return found

    def mapped(fields: Column) -> Column:
        return _let(_let(fingerprint(fields), chosen), lambda m: F.struct(m["name"].alias("layout"), F.when(m.isNotNull(), _mapped(fields, m)).alias("turns")))

    found = records.withColumn(both, _let(_fields(F.col(record)), mapped))
    return found.select(*[c for c in records.columns if c != record], F.col(both)["layout"].alias("layout"), F.col(both)["turns"].alias("turns"))


def escape(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column, escapes: tuple[tuple[str, str], ...] = ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def render(turns: Column) -> tuple[Column, Column]:
    """The formatted string of an array of turns and its loss mask: (turn, start, length) in code points of that turn's part.

    The mask covers the written text of every assistant turn and nothing else.
    """
    formatted = F.array_join(F.transform(turns, lambda t: F.concat(F.lit(TURN), escape(t["role"], ROLE_ESCAPES), F.lit("\n"), escape(t["text"]), F.lit(END))), "")
    spans = F.transform(turns, lambda t, i: F.struct(i.alias("turn"), (F.length(escape(t["role"], ROLE_ESCAPES)) + len(TURN) + 1).alias("start"), F.length(escape(t["text"])).alias("length"), t["role"].alias("role")))
    mask = F.transform(F.filter(spans, lambda s: s["role"] == "assistant"), lambda s: s.dropFields("role"))
    return formatted, mask


def read_back(formatted: Column) -> Column:
    """The turns of a formatted string, unescaped."""
    parts = F.filter(F.split(formatted, r"<\|end\|>"), lambda p: p != "")
    bodies = F.transform(parts, lambda p: F.substr(p, F.lit(len(TURN) + 1)))
    return F.transform(bodies, lambda b: _turn(unescape(F.substring_index(b, "\n", 1), ROLE_ESCAPES), unescape(F.substr(b, F.instr(b, "\n") + 1))))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    parts = F.split(formatted, r"<\|end\|>")
    return F.array_join(F.transform(mask, lambda m: unescape(F.substr(F.element_at(parts, m["turn"] + 1), m["start"] + 1, m["length"]))), "")


def format_turn_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Format conversations that are stored a row a turn: (conv_id, block, formatted, loss_mask, n_turns), blocks of BLOCK turn numbers.

    A conversation's output is its blocks in order, one after the other. Turns are ordered by number, then role, then
    text; a null number comes first, null roles and texts are empty; repeated rows are turns of their own.
    """
    source = rows.select(
        F.col(conv).alias("conv_id"),
        F.coalesce(F.col(turn).cast("long"), F.lit(-(2**62))).alias("turn"),
        F.to_variant_object(F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))).alias("record"),
    )
    # Each record is one turn. The outer form spares the filter that Spark puts below the plain one, which would map every record twice.
    turns = canonical_turns(source, "record").select("conv_id", "turn", F.explode_outer("turns").alias("t"))
    blocks = turns.groupBy("conv_id", F.floor(F.col("turn") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("turn", "t.role", "t.text"))).alias("turns"))
    formatted, mask = render(F.col("turns"))
    return blocks.select("conv_id", "block", formatted.alias("formatted"), mask.alias("loss_mask"), F.size("turns").cast("long").alias("n_turns"))


def digests(blocks: DataFrame) -> DataFrame:
    """Per conversation what the formatted blocks hold, read back from them."""
    back = blocks.select("conv_id", "block", "formatted", "loss_mask", read_back(F.col("formatted")).alias("turns")).select(
        "conv_id",
        F.struct(
            "block",
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
            masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
        ).alias("part"),
        F.size("turns").cast("long").alias("n_turns"),
        F.length("formatted").cast("long").alias("chars"),
    )
    whole = back.groupBy("conv_id").agg(F.array_sort(F.collect_list("part")).alias("parts"), F.sum("n_turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"))
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("parts", lambda p: p["said"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts hold another template's control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
