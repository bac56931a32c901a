"""What a SQL text asks a store for, as Spark's own parser reads it.

Spark has no table function whose columns depend on its arguments. But a store prepares a text before Spark analyses
it: calls of its table functions with literal arguments become temporary views, and a ``CALL`` of one of its procedures
is carried out. The parsed plan tells which names are relations, which are functions, and what their arguments are, so
that nothing inside a string, a comment or a quoted name counts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import ParseException
from pyspark.sql import SparkSession

from tablesnap.errors import WrongCall

# What is no code: raw strings, strings, quoted names, comments.
NO_CODE = re.compile(
    r"""(?<!\w)[rR]'[^']*'|(?<!\w)[rR]"[^"]*"|'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|--[^\n]*|/\*.*?\*/""",
    re.DOTALL,
)
PLACE = "tablesnap_call_"  # names a call while it is looked for

Value = str | bool | int | float | None


@dataclass(frozen=True)
class Parameter:
    """``kind`` is the type of its values. A parameter without ``required`` has a default."""

    name: str
    kind: type = str
    required: bool = False


@dataclass(frozen=True)
class Signature:
    """What a function takes: the required parameters by place or by name, the others by name alone. One with an
    ``effect`` changes the store."""

    name: str
    parameters: Sequence[Parameter] = ()
    effect: bool = True

    def usage(self) -> str:
        shown = [p.name if p.required else f"{p.name} => …" for p in self.parameters]
        return f"{self.name}({', '.join(shown)})"

    def bind(self, positional: Sequence[Value], named: Mapping[str, Value]) -> dict[str, Value]:
        """The arguments by name. Wrong ones raise before anything is done."""
        required = [p.name for p in self.parameters if p.required]
        if len(positional) > len(required):
            raise WrongCall(f"{self.usage()} takes {len(required)} arguments by place, {len(positional)} were given.")
        found = dict(zip(required, positional, strict=False))
        for name, value in named.items():
            if name.lower() in found:
                raise WrongCall(f"{self.usage()}: {name} is given twice.")
            found[name.lower()] = value
        known = {p.name: p for p in self.parameters}
        for name in found:
            if name not in known:
                raise WrongCall(f"{self.usage()} has no parameter {name}.")
        missing = [name for name in required if found.get(name) is None]
        if missing:
            raise WrongCall(f"{self.usage()} needs a value for {' and '.join(missing)}.")
        return {n: self._typed(known[n], v) for n, v in found.items() if v is not None}

    def _typed(self, parameter: Parameter, value: Value) -> Value:
        if parameter.kind is bool and isinstance(value, str) and value.lower() in ("true", "false"):
            return value.lower() == "true"
        if type(value) is not parameter.kind:
            raise WrongCall(f"{self.usage()}: {parameter.name} must be a {parameter.kind.__name__}.")
        return value


@dataclass(frozen=True)
class Call:
    """A call as written: its arguments, and in a query the letters it takes there."""

    name: str
    positional: Sequence[Value]
    named: Mapping[str, Value]
    begin: int = 0
    end: int = 0


@dataclass
class Asked:
    """``relations`` and ``functions`` are the names a text uses as such, in lower case; ``calls`` its calls of table
    functions, ``procedure`` what it calls as a statement."""

    relations: set[str] = field(default_factory=set)
    functions: set[str] = field(default_factory=set)
    calls: list[Call] = field(default_factory=list)
    procedure: Call | None = None
    explains: bool = False

    def replaced(self, text: str, relations: Sequence[str]) -> str:
        """The text with a relation's name in place of each of the calls."""
        for call, name in sorted(zip(self.calls, relations, strict=True), key=lambda c: -c[0].begin):
            text = text[: call.begin] + name + text[call.end :]
        return text


def parsed(spark: SparkSession, text: str) -> list[dict]:
    """Spark's parsed plan of a text: the nodes in order, subqueries inside those that hold them."""
    return json.loads(spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toJSON())


def nodes_of(found: object) -> Iterator[dict]:
    """All nodes of plans and expressions, wherever they stand."""
    if isinstance(found, dict):
        if "class" in found:
            yield found
        found = list(found.values())
    if isinstance(found, list):
        for part in found:
            yield from nodes_of(part)


def kind_of(node: dict) -> str:
    return node["class"].rpartition(".")[2]


def name_of(written: str) -> str:
    """A name of one part; one of several parts is never a name that is asked for."""
    return written[1:-1].lower()


def value_of(nodes: Sequence[dict], args: object, function: str) -> Value:
    """The value of an argument: a literal, or a named parameter of the statement."""
    kind = kind_of(nodes[0])
    if len(nodes) == 1 and kind == "Literal":
        value, of = nodes[0]["value"], nodes[0]["dataType"]
        if value is None or of == "string":
            return value
        if of == "boolean":
            return value == "true"
        return int(value) if re.fullmatch(r"-?\d+", value) else float(value)
    if len(nodes) == 1 and kind == "NamedParameter" and isinstance(args, Mapping) and nodes[0]["name"] in args:
        value = args[nodes[0]["name"]]
        if value is None or isinstance(value, (str, bool, int, float)):
            return value
    raise WrongCall(f"{function}: arguments must be literals or named parameters.")


def arguments(given: Sequence[Sequence[dict]], args: object, function: str) -> tuple[list[Value], dict[str, Value]]:
    positional, named = [], {}
    for nodes in given:
        if kind_of(nodes[0]) == "NamedArgumentExpression":
            name = nodes[0]["key"]
            if name in named:
                raise WrongCall(f"{function}: {name} is given twice.")
            named[name] = value_of(nodes[1:], args, function)
        else:
            positional.append(value_of(nodes, args, function))
    return positional, named


def written_calls(text: str, names: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """Where the text may call one of the functions: name, its begin and end, and the end of the call."""
    code = NO_CODE.sub(lambda m: "'" * len(m[0]), text)
    found = []
    for match in re.finditer(rf"(?<![\w.])({'|'.join(names)})(?=\s*\()", code, re.IGNORECASE):
        depth, at = 0, code.index("(", match.end())
        for end in range(at, len(code)):
            depth += {"(": 1, ")": -1}.get(code[end], 0)
            if not depth:
                found.append((match[1].lower(), match.start(), match.end(), end + 1))
                break
    return found


def asked(spark: SparkSession, text: str, args: object, table_functions: Sequence[str]) -> Asked | None:
    """What a text asks for; None if Spark cannot parse it, which its own error tells best."""
    written = written_calls(text, table_functions)
    marked = text
    for n, (_, begin, end, _) in reversed(list(enumerate(written))):
        marked = f"{marked[:begin]}{PLACE}{n}{marked[end:]}"
    try:
        plan = parsed(spark, marked)
    except ParseException:
        return None
    found = Asked()
    if not plan:
        return found
    found.explains = kind_of(plan[0]) == "ExplainCommand"
    for node in nodes_of(plan):
        kind = kind_of(node)
        if kind == "UnresolvedRelation":
            found.relations.add(name_of(node["multipartIdentifier"]))
        elif kind == "UnresolvedFunction":
            found.functions.add(name_of(node["nameParts"]))
        elif kind == "UnresolvedTableValuedFunction":
            name = name_of(node["name"])
            found.functions.add(name)
            if name.startswith(PLACE):
                name, begin, _, end = written[int(name[len(PLACE) :])]
                found.calls.append(Call(name, *arguments(node["functionArgs"], args, name), begin, end))
    if kind_of(plan[0]) == "Call":
        name = next(name_of(n["nameParts"]) for n in nodes_of(plan) if kind_of(n) == "UnresolvedProcedure")
        if name.startswith(PLACE):
            name = written[int(name[len(PLACE) :])][0]
        try:
            found.procedure = Call(name, *arguments(plan[0]["args"], args, name))
        except WrongCall:
            # Another catalog's procedure may take what it likes.
            if name in table_functions:
                raise
    return found
