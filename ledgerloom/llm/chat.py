r"""Chat formatting by schema fingerprints, all in built-in functions.

A record's nested field paths that hold something (`messages[]`, `messages[].role`, `prompt`, ...) are hashed; the hash
selects one of the declared LAYOUTS, whose mapping turns the record into canonical turns (role, text). The table is what
Spark reads from mixed JSON lines or joins together: one column for each top-level field, null where a record lacks it.

The template marks a turn as `<|im_start|>role`, a newline, the text, `<|im_end|>` and a newline. Control strings of this
and of other common templates get one more backslash after their first character wherever they stand in a text or role
(`</s>` becomes `<\/s>`, `<\/s>` becomes `<\\/s>`), so that none is left and taking one away gives the text back. In roles,
backslash and newline are spelled \b and \n first. The loss mask has a (skip, train, rest) for each turn: code points before,
in and after what is trained on; only texts of assistants are trained on. `read_back` undoes it all from string and mask.

Edge cases: a null text of a turn is an empty text, a null role an empty role; a null field of a flat layout is no turn. A
record whose fields fit no layout, or none at all, keeps its row, with layout, formatted and mask null. Fields in no
layout don't count. Turn rows sort by turn (nulls first), then role and text; repeated rows stay repeated turns; rows
without conv_id are one conversation without id. Empty tables give no rows. One conversation is one string, so it must fit
into a row (2 GB); that is what a formatted conversation and its digest are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import common

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common chat templates, by their first character and the rest.
CONTROLS = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|\|system\|>|\|user\|>|\|assistant\|>|\|end\|>|\|eot_id\|>|\|begin_of_text\|>|\|end_of_text\|>|\|start_header_id\|>|\|end_header_id\|>|\|endoftext\|>|/?s>|/?SYS>>|start_of_turn>|end_of_turn>|/?INST\])"
TURN = "struct<role:string,text:string>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROLS, r"$1$2\\$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, CONTROLS.replace(r"(\\*)", r"\\(\\*)"), "$1$2$3")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


@dataclass(frozen=True)
class Flat:
    """Turns from single fields: (role, fields whose texts are joined by a blank line)."""

    parts: tuple[tuple[str, tuple[str, ...]], ...]

    def turns(self, get: Callable[[str], Column], has: Callable[[str], bool]) -> Column:
        texts = [(role, F.concat_ws("\n\n", *[get(f).cast("string") for f in fields]), reduce(Column.__or__, [get(f).isNotNull() for f in fields])) for role, fields in self.parts]
        return F.array_compact(F.array(*[F.when(there, turn(F.lit(role), text)) for role, text, there in texts]))


@dataclass(frozen=True)
class Each:
    """A turn from each element of a list; roles of other names are renamed, a lead field comes first."""

    items: str
    role: str
    text: str
    names: dict = field(default_factory=dict)
    lead: tuple[str, str] | None = None

    def turns(self, get: Callable[[str], Column], has: Callable[[str], bool]) -> Column:
        def part(x: Column, name: str) -> Column:
            return (x[name] if has(f"{self.items}[].{name}") else F.lit(None)).cast("string")

        def one(x: Column) -> Column:
            said = role = part(x, self.role)
            for old, new in self.names.items():
                said = F.when(role == old, F.lit(new)).otherwise(said)
            return turn(said, part(x, self.text))

        found = F.transform(get(self.items), one)
        if self.lead is None:
            return found
        role, name = self.lead
        return F.concat(F.array_compact(F.array(F.when(get(name).isNotNull(), turn(F.lit(role), get(name).cast("string"))))), found)


@dataclass(frozen=True)
class Pairs:
    """Two turns from each pair of a list, then the fields that follow."""

    items: str
    then: Flat

    def turns(self, get: Callable[[str], Column], has: Callable[[str], bool]) -> Column:
        both = F.flatten(F.transform(get(self.items), lambda x: F.array(turn(F.lit("user"), F.get(x, 0)), turn(F.lit("assistant"), F.get(x, 1)))))
        return F.concat(F.coalesce(both, F.array().cast(f"array<{TURN}>")), self.then.turns(get, has))


@dataclass(frozen=True)
class Layout:
    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...]
    mapping: Flat | Each | Pairs

    def prints(self) -> Iterator[str]:
        """The fingerprints of all records of this layout."""
        for k in range(len(self.may) + 1):
            for more in combinations(self.may, k):
                yield fingerprint_of((*self.needs, *more))


_HUMAN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}
LAYOUTS = (
    Layout("messages", ("messages[]",), ("messages[].role", "messages[].content", "system"), Each("messages", "role", "content", lead=("system", "system"))),
    Layout("conversations", ("conversations[]",), ("conversations[].from", "conversations[].value", "system"), Each("conversations", "from", "value", _HUMAN, ("system", "system"))),
    Layout("dialog", ("data.dialog[]",), ("data.dialog[].speaker", "data.dialog[].utterance"), Each("data.dialog", "speaker", "utterance", _HUMAN)),
    Layout("prompt", ("prompt",), ("completion", "system"), Flat((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))))),
    Layout("completion", ("completion",), ("system",), Flat((("system", ("system",)), ("assistant", ("completion",))))),
    Layout("response", ("prompt", "response"), ("system",), Flat((("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))))),
    Layout("instruction", ("instruction",), ("input", "output", "system"), Flat((("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))))),
    Layout("history", ("instruction", "history[][]"), ("input", "output"), Pairs("history", Flat((("user", ("instruction", "input")), ("assistant", ("output",)))))),
    Layout("question", ("question",), ("answer", "context"), Flat((("user", ("context", "question")), ("assistant", ("answer",))))),
)
KNOWN = sorted({p for x in LAYOUTS for p in (*x.needs, *x.may)})


def fingerprint_of(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _holds(name: str) -> Callable[[Column], Column]:
    return lambda x: x[name].isNotNull()


def paths(kind: T.DataType, at: str, value: Column) -> Iterator[tuple[str, Column]]:
    """Each nested path below a column with whether a row holds something there. A list holds something as soon as it is one:
    x[] is a list of structs, x[][] one of lists, x[*] one of plain values."""
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from paths(f.dataType, f"{at}.{f.name}", value[f.name])
    elif isinstance(kind, T.ArrayType):
        of = kind.elementType
        yield at + ("[]" if isinstance(of, T.StructType) else "[][]" if isinstance(of, T.ArrayType) else "[*]"), value.isNotNull()
        if isinstance(of, T.StructType):
            for f in of.fields:
                for path, _ in paths(f.dataType, f"{at}[].{f.name}", F.lit(None)):
                    yield path, F.exists(value, _holds(f.name))
    else:
        yield at, value.isNotNull()


def known(records: DataFrame) -> list[tuple[str, Column]]:
    return sorted(((p, there) for c in records.schema.fields for p, there in paths(c.dataType, c.name, F.col(f"`{c.name}`")) if p in KNOWN), key=lambda x: x[0])


def fingerprint(held: list[tuple[str, Column]]) -> Column:
    """The hash of the known paths that a record holds; null if it holds none."""
    if not held:
        return F.lit(None).cast("string")
    names = F.concat_ws("\n", *[F.when(there, F.lit(p)) for p, there in held])
    return F.when(names != "", F.sha2(names, 256))


def canonical(records: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """(id, layout, turns) of each record; columns other than the id are its fields."""
    held = known(records.drop(id_col))
    there = {p for p, _ in held}
    fields = sorted({p.split(".")[0].split("[")[0] for p in there})
    rows = records.select(F.col(f"`{id_col}`").alias("id"), F.struct(*[F.col(f"`{c}`") for c in fields] or [F.lit(None).alias("none")]).alias("r"), fingerprint(held).alias("print"))

    def get(name: str) -> Column:
        lost = not there & {name, f"{name}[]", f"{name}[][]"}
        return F.lit(None).cast("string") if lost else reduce(lambda x, n: x[n], name.split("."), F.col("r"))

    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(f"array<{TURN}>")
    for x in reversed(LAYOUTS):
        if not set(x.needs) <= there:
            continue
        own = F.col("print").isin(*x.prints())
        layout, turns = F.when(own, F.lit(x.name)).otherwise(layout), F.when(own, x.mapping.turns(get, there.__contains__)).otherwise(turns)
    return rows.select("id", layout.alias("layout"), turns.alias("turns"))


def formatted(records: DataFrame, id_col: str = "conv_id", trained: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(id, layout, formatted, mask array<struct<skip, train, rest>>) of each record."""
    rows = canonical(records, id_col)
    pieces = F.transform("turns", lambda t: F.struct(F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"), t["role"].isin(*trained).alias("own")))
    rows = rows.select("id", "layout", pieces.alias("pieces"))
    head, body = lambda p: F.char_length(p["head"]), lambda p: F.char_length(p["body"])
    end = F.lit(len(END))
    mask = F.transform("pieces", lambda p: F.struct(
        F.when(p["own"], head(p)).otherwise(head(p) + body(p) + end).alias("skip"), F.when(p["own"], body(p)).otherwise(0).alias("train"), F.when(p["own"], end).otherwise(0).alias("rest"),
    ))
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    return rows.select(F.col("id").alias(id_col), "layout", whole.alias("formatted"), mask.alias("mask"))


def read_back(rows: DataFrame) -> DataFrame:
    """Adds turns array<struct<role, text>> and trained array<string>, both from the formatted string and its mask."""
    parts = F.split("formatted", END.replace("|", r"\|"), -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def one(x: Column) -> Column:
        line = F.call_function("instr", x, F.lit("\n"))
        return F.struct(unescaped_role(F.substring(x, F.lit(len(START) + 1), line - F.lit(len(START) + 1))).alias("role"), unescaped(F.substring(x, line + F.lit(1), F.char_length(x))).alias("text"))

    trained = F.filter(F.zip_with(parts, "mask", lambda x, m: F.when(m["rest"] > 0, unescaped(F.substring(x, m["skip"] + F.lit(1), m["train"])))), lambda x: x.isNotNull())
    return rows.withColumn("turns", F.transform(parts, one)).withColumn("trained", trained)


def records(turns: DataFrame) -> DataFrame:
    """Rows by turn as records of the messages layout."""
    rows = turns.select("conv_id", F.struct("turn", F.col("role").cast("string").alias("role"), common.text_or_empty(F.col("text")).alias("content")).alias("m"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m"))
    return rows.select("conv_id", F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = records(common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit("</s>[INST] ok [/INST]").alias("prompt"), F.lit("</s>[INST] ok [/INST]").alias("completion"))
    got = read_back(formatted(given.unionByName(extra, allowMissingColumns=True)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("trained", "")
    return got.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op13_sql() -> str:
    """The digests straight from the rows; the escapes by their effect on lengths."""
    longer = "regexp_replace({0}, '" + CONTROLS.replace("'", "''") + r"', '\1\2\\\3', 'g')"
    role = longer.format(r"replace(replace(role, '\', '\b'), chr(10), '\n')")
    return f"""with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text, false as extra from conversations
            union all select -1, k, r, '</s>[INST] ok [/INST]', true from (values (0, 'user'), (1, 'assistant')) x(k, r)),
        s as (select *, {len(START) + 1 + len(END)} + length({role}) + length({longer.format("text")}) as chars from t)
        select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
            coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
            sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256, sum(chars)::bigint as formatted_chars
        from s group by conv_id, extra"""
