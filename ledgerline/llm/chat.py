"""Chat formatting, in DataFrame and SQL functions only.

Records of unlike layouts (message lists, prompt and answer, instruction and
output) lie side by side in one wide schema with nulls where a layout lacks a
field. A record's fingerprint hashes the nested field paths that are present
in it; the fingerprint selects a declarative mapping, which turns the record
into canonical turns (role, text). Turns are then written in a template whose
control strings cannot be forged by a text: inside texts they are escaped,
reversibly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import replace_columns

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that some chat template treats as control; each begins with < or [.
CONTROLS = [START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]"]

_TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: either ``messages`` (a list and its role
    and text fields) or ``parts`` (a role for each flat field, in order).
    ``roles`` renames roles. ``optional``: paths that may be absent."""

    name: str
    messages: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()
    optional: tuple[str, ...] = field(default=())

    def paths(self) -> list[str]:
        if self.messages:
            at, role, text = self.messages
            return [f"{at}[]", f"{at}[].{role}", f"{at}[].{text}"]
        return [p for _, p in self.parts]

    def fingerprints(self) -> list[str]:
        must = [p for p in self.paths() if p not in self.optional]
        may = [p for p in self.paths() if p in self.optional]
        return [path_hash([*must, *some]) for n in range(len(may) + 1) for some in combinations(may, n)]


def _messages(name: str, at: str, role: str, text: str, roles: tuple = ()) -> Mapping:
    return Mapping(name, messages=(at, role, text), roles=roles, optional=(f"{at}[].{role}", f"{at}[].{text}"))


MAPPINGS = [
    _messages("messages", "messages", "role", "content"),
    _messages("conversations", "conversations", "from", "value", (("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt-response", parts=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system", "response")),
    Mapping("prompt-completion", parts=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("instruction-output", parts=(("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
    Mapping("question-answer", parts=(("user", "question"), ("assistant", "answer"))),
]


def path_hash(paths: Sequence[str]) -> str:
    return hashlib.sha256("|".join(sorted(paths)).encode()).hexdigest()


def _present(schema: T.StructType) -> dict[str, Column]:
    """Path: whether a row has it. Fields of list elements count if any element has them."""
    out: dict[str, Column] = {}

    def walk(kind: T.DataType, at: Column, path: str, any_of) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, at[f.name], f"{path}.{f.name}" if path else f.name, any_of)
        elif isinstance(kind, T.ArrayType):
            out[f"{path}[]"] = any_of(at, lambda x: F.size(x) > 0)
            if isinstance(kind.elementType, T.StructType):
                for f in kind.elementType.fields:
                    inner = lambda x, f=f: F.exists(x, lambda e: e[f.name].isNotNull())
                    out[f"{path}[].{f.name}"] = any_of(at, inner)
        else:
            out[path] = any_of(at, lambda x: x.isNotNull())

    for f in schema.fields:
        walk(f.dataType, F.col(f"`{f.name}`"), f.name, lambda at, test: F.coalesce(test(at), F.lit(False)))
    return out


def fingerprint(schema: T.StructType, among: Sequence[str] | None = None) -> Column:
    """Hash of the sorted nested field paths present in a record; ``among``: of these only."""
    paths = _present(schema)
    wanted = sorted(p for p in paths if among is None or p in among)
    return F.sha2(F.concat_ws("|", *[F.when(paths[p], F.lit(p)) for p in wanted]), 256)


def _turns(m: Mapping, schema: T.StructType) -> Column | None:
    names = set(_present(schema))
    if not {p for p in m.paths() if p not in m.optional} <= names:
        return None
    rename = lambda role: F.coalesce(*[F.when(role == a, F.lit(b)) for a, b in m.roles], role, F.lit(""))
    none = F.lit(None).cast("string")
    if m.messages:
        at, role, text = m.messages
        get = lambda x, f: x[f].cast("string") if f"{at}[].{f}" in names else none
        return F.transform(F.col(at), lambda x: F.struct(rename(get(x, role)).alias("role"), F.coalesce(get(x, text), F.lit("")).alias("text")))
    parts = [F.when(F.col(p).isNotNull(), F.struct(F.lit(r).alias("role"), F.col(p).cast("string").alias("text"))) for r, p in m.parts if p in names]
    return F.filter(F.array(*parts), lambda x: x.isNotNull())


def canonical_turns(records: DataFrame, id_cols: Sequence[str], mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """``id_cols``, ``layout`` (mapping's name; null if no mapping knows the
    fingerprint), ``fingerprint``, ``turns``.

    The fingerprint that selects a mapping is of the paths that mappings name,
    so columns beside a record (a source, a licence) do not change it. Unknown
    layouts have no turns but keep their row, under the fingerprint of all
    their paths, so that these can be counted and mapped. Null texts are
    empty; texts of any length are taken whole; an empty table gives an empty
    result. A record with the fields of two layouts is of unknown layout.
    """
    body = T.StructType([f for f in records.schema.fields if f.name not in id_cols])
    named = {p for m in mappings for p in m.paths()}
    marked = records.withColumn("__fingerprint", fingerprint(body, named))
    layout, turns = F.lit(None).cast("string"), F.array().cast(_TURNS)
    for m in reversed(list(mappings)):
        made = _turns(m, body)
        if made is not None:
            known = F.col("__fingerprint").isin(m.fingerprints())
            layout = F.when(known, F.lit(m.name)).otherwise(layout)
            turns = F.when(known, made.cast(_TURNS)).otherwise(turns)
    mark = F.when(layout.isNotNull(), F.col("__fingerprint")).otherwise(fingerprint(body))
    return marked.select(*id_cols, layout.alias("layout"), mark.alias("fingerprint"), turns.alias("turns"))


def records_from_rows(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows by turn to one record per conversation with a ``messages`` list,
    ordered by turn (null first), then role and text, so ties and repeated
    rows have one order. A null conversation id is one conversation. A
    conversation is one record and later one text, so its rows meet in one task."""
    listed = F.sort_array(F.collect_list(F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("content"))))
    grouped = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(listed.alias("__rows"))
    return grouped.select("conv_id", F.transform("__rows", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def _rest(first: str) -> str:
    return "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first)


def escape(text: Column) -> Column:
    """Put a backslash (one more, if some are there) after the first
    character of every control string."""
    return F.regexp_replace(text, rf"(<\\*(?=(?:{_rest('<')}))|\[\\*(?=(?:{_rest('[')})))", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(<\\*)\\(?=(?:{_rest('<')}))|(\[\\*)\\(?=(?:{_rest('[')}))", "$1$2")


#: Roles stand in a header line: what could end or forge it is percent-encoded.
_ROLE = [("%", "%25"), ("\n", "%0A"), ("<", "%3C"), ("[", "%5B")]


def _role_out(role: Column) -> Column:
    for a, b in _ROLE:
        role = F.replace(role, F.lit(a), F.lit(b))
    return role


def _role_in(role: Column) -> Column:
    for a, b in reversed(_ROLE):
        role = F.replace(role, F.lit(b), F.lit(a))
    return role


def format_turns(chats: DataFrame, turns_col: str = "turns", trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """Adds ``segments`` (text, loss), the template's pieces in order with the
    loss mask, ``formatted``, their concatenation, and ``loss_spans`` (start,
    end), the code points of it under the mask. Only texts of ``trained`` roles
    are under the mask. Columns of these names are replaced."""
    chats = replace_columns(chats, ["segments", "formatted", "loss_spans"])
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))

    def turn(t: Column) -> Column:
        return F.array(
            piece(F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n")), F.lit(False)),
            piece(escape(t["text"]), t["role"].isin(list(trained))),
            piece(F.lit(END + "\n"), F.lit(False)),
        )

    made = chats.withColumn("segments", F.flatten(F.transform(turns_col, turn)))
    spans = F.expr(
        "aggregate(segments, named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int>>)), "
        "(a, s) -> named_struct('at', a.at + length(s.text), 'spans', if(s.loss, concat(a.spans, array(named_struct('start', a.at, 'end', a.at + length(s.text)))), a.spans)), a -> a.spans)"
    )
    return made.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")).withColumn("loss_spans", spans)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted chat, unescaped."""
    pieces = F.slice(F.split(formatted, re.escape(START)), 2, 2_000_000_000)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        n = F.length(head) + 1
        text = F.substring(piece, n + 1, F.length(piece) - n - F.lit(len(END) + 1))
        return F.struct(_role_in(head).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text of a formatted chat under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
