"""Syntax facts of Python texts: one parse per file, flat facts out, all evaluation in Spark.

The only Python step is :func:`with_facts`. It walks a tree once and writes down what is there; what
the facts mean (counts, taint, complexity, findings) is left to column expressions on the same row,
so no file is shuffled to be judged.
"""

from __future__ import annotations

import ast
import io
import tokenize
import warnings
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codesieve.functions.unnest import unnest, unnest_structs

# Texts in a call that mark it as user input.
INPUT_SOURCES = ("request.args.get", "request.form.get", "request.json.get", "input(")

# Node kinds that count as control structures.
CONTROL_KINDS = ("If", "For", "While", "Try", "With")


def _list_of(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(name, kind) for name, kind in fields.items()]))


_TEXT, _INT, _FLAG, _TEXTS = T.StringType(), T.IntegerType(), T.BooleanType(), T.ArrayType(T.StringType())
_ASSIGNS = _list_of(targets=_TEXTS, is_source=_FLAG, copied_from=_TEXT)
FACTS = T.StructType(
    [
        T.StructField("parse_ok", _FLAG),
        T.StructField("nodes", _list_of(kind=_TEXT, depth=_INT)),
        T.StructField("statements", _INT),
        T.StructField("imports", _INT),
        T.StructField("blocks", _list_of(block=_INT, parent=_INT, kind=_TEXT, decisions=_INT)),
        T.StructField("assigns", _ASSIGNS),
        T.StructField(
            "calls", _list_of(func=_TEXT, attr=_TEXT, args=_list_of(kind=_TEXT, name=_TEXT, names=_TEXTS))
        ),
        T.StructField("operators", _list_of(scope=_TEXT, names=_TEXTS, operands=_TEXTS)),
        T.StructField("comment_tokens", _INT),
        T.StructField("source_lines", _INT),
        T.StructField("docstring_lines", _INT),
    ]
)
FACT_NAMES = tuple(field.name for field in FACTS.fields)

_FUNCTIONS = (ast.FunctionDef, ast.AsyncFunctionDef)
_IMPORTS = (ast.Import, ast.ImportFrom)


#: Nodes at which control can go one way more, and the lists whose every entry is a way of its own.
ONE_WAY_MORE = (ast.If, ast.IfExp, ast.Assert, ast.For, ast.AsyncFor, ast.While, ast.comprehension)
WAYS_LISTED = {"handlers": (ast.Try, ast.TryStar), "ifs": (ast.comprehension,)}
#: Nodes whose ``else`` is a way of its own: it is taken when they were not left early.
ELSE_COUNTS = (ast.For, ast.AsyncFor, ast.While, ast.Try, ast.TryStar)

#: Nodes that are operators by Halstead's count.
SIGNS = (ast.operator, ast.unaryop, ast.boolop, ast.cmpop)
#: Where an operand that can occur again is spelled.
SPELLING = {ast.Name: "id", ast.Attribute: "attr", ast.Constant: "value"}


def _decisions(node: ast.AST) -> int:
    """Ways through a node beyond the first (McCabe)."""
    ways = int(isinstance(node, ONE_WAY_MORE))
    ways += sum(len(getattr(node, field)) for field, kinds in WAYS_LISTED.items() if isinstance(node, kinds))
    if isinstance(node, ELSE_COUNTS) and node.orelse:
        ways += 1
    if isinstance(node, ast.BoolOp):
        ways += len(node.values) - 1
    if isinstance(node, ast.Match):
        ways += sum(not _takes_all(case) for case in node.cases)
    return ways


def _takes_all(case: ast.match_case) -> bool:
    """Is it a bare name or ``_`` without a condition?"""
    return isinstance(case.pattern, ast.MatchAs) and case.pattern.pattern is None and case.guard is None


def _operation(node: ast.AST) -> tuple[list[ast.AST], list[ast.AST]] | None:
    """The operators that stand in an expression or statement itself, and what they are applied to."""
    parts = list(ast.iter_child_nodes(node))
    signs = [part for part in parts if isinstance(part, SIGNS)]
    return (signs, [part for part in parts if isinstance(part, ast.expr)]) if signs else None


def _operand(node: ast.AST) -> str:
    """Names, attributes and literals count once by their spelling; anything compound is an operand of its own."""
    field = SPELLING.get(type(node))
    if field is None:
        return f"place:{id(node)}"
    spelled = getattr(node, field)
    return f"{type(spelled).__name__}:{spelled!r}"


def _names(node: ast.AST) -> list[str]:
    return [n.id for n in ast.walk(node) if isinstance(n, ast.Name)]


def _assign(node: ast.Assign) -> tuple | None:
    """(names set, is it user input, name copied), for assignments that can carry taint."""
    targets = [t.id for t in node.targets if isinstance(t, ast.Name)]
    if not targets:
        return None
    if isinstance(node.value, ast.Call):
        text = ast.unparse(node.value)
        return (targets, True, None) if any(source in text for source in INPUT_SOURCES) else None
    return (targets, False, node.value.id) if isinstance(node.value, ast.Name) else None


def _call(node: ast.Call) -> tuple:
    args = [(type(a).__name__, a.id if isinstance(a, ast.Name) else None, _names(a)) for a in node.args]
    return ast.unparse(node.func), getattr(node.func, "attr", None), args


def _line_facts(code: str, tree: ast.AST) -> tuple[int, int, int]:
    """Comments, lines that hold code, and lines of texts that stand alone over several lines."""
    alone = [
        range(n.lineno, n.end_lineno + 1)
        for n in ast.walk(tree)
        if isinstance(n, ast.Expr) and isinstance(n.value, ast.Constant) and isinstance(n.value.value, str)
    ]
    standing = {line for span in alone for line in span}
    idle = {tokenize.NL, tokenize.NEWLINE, tokenize.INDENT, tokenize.DEDENT, tokenize.ENDMARKER}
    comments, held = 0, set()
    for token in tokenize.generate_tokens(io.StringIO(code).readline):
        if token.type == tokenize.COMMENT:
            comments += 1
        elif token.type not in idle:
            held.update(range(token.start[0], token.end[0] + 1))
    return comments, len(held - standing), sum(len(span) for span in alone if len(span) > 1)


def file_facts(code: str | None) -> dict:
    """All facts of one text; ``parse_ok`` is false, and the rest empty, when it does not parse."""
    empty = dict.fromkeys(FACT_NAMES)
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            tree = ast.parse(code)
            comments, held, standing = _line_facts(code, tree)
            calls = [_call(n) for n in ast.walk(tree) if isinstance(n, ast.Call)]
            nodes, assigns, operators, blocks = [], [], [], [[0, -1, "module", 0]]
            statements = imports = 0
            # Depth-first, in the order of the text. ``block`` is None where branches do not count.
            pending = [(tree, 0, 0, "")]
            while pending:
                node, above, block, scope = pending.pop()
                statements += isinstance(node, ast.stmt)
                if isinstance(node, _IMPORTS):
                    imports += 1
                    continue
                depth = above + (2 if isinstance(node, (ast.FunctionDef, ast.ClassDef)) else 1)
                nodes.append((type(node).__name__, depth))
                if isinstance(node, ast.Assign) and (found := _assign(node)):
                    assigns.append(found)
                if operation := _operation(node):
                    ops, operands = operation
                    operators.append((scope, [type(o).__name__ for o in ops], [_operand(o) for o in operands]))
                if block is not None:
                    blocks[block][3] += _decisions(node)
                opens = isinstance(node, (*_FUNCTIONS, ast.ClassDef))
                inner = block
                if opens and block is not None:
                    inner = len(blocks)
                    blocks.append([inner, block, "class" if isinstance(node, ast.ClassDef) else "function", 0])
                inside = {id(n) for n in node.body} if opens else None
                below = node.name if isinstance(node, _FUNCTIONS) else scope
                for child in reversed(list(ast.iter_child_nodes(node))):
                    counted = not isinstance(node, ast.Assert) and (inside is None or id(child) in inside)
                    pending.append((child, depth, inner if counted else None, below))
    except (SyntaxError, ValueError, RecursionError, MemoryError, TypeError, tokenize.TokenError):
        return empty | {"parse_ok": False}
    return dict(
        parse_ok=True,
        nodes=nodes,
        statements=statements,
        imports=imports,
        blocks=[tuple(b) for b in blocks],
        assigns=assigns,
        calls=calls,
        operators=operators,
        comment_tokens=comments,
        source_lines=held,
        docstring_lines=standing,
    )


def with_facts(files: DataFrame) -> DataFrame:
    """Add the facts of ``code`` to every row. A narrow step: rows stay in their partitions."""
    schema = T.StructType([*files.schema.fields, *FACTS.fields])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = {field.name: to_arrow_type(field.dataType) for field in FACTS.fields}
        for batch in batches:
            rows = [file_facts(code) for code in batch.column("code").to_pylist()]
            columns = [pa.array([row[name] for row in rows], type=kinds[name]) for name in FACT_NAMES]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *FACT_NAMES])

    return files.mapInArrow(extract, schema)


def _count(kinds: tuple[str, ...]) -> Column:
    return F.size(F.filter("nodes", lambda n: n["kind"].isin(*kinds)))


def node_counts() -> dict[str, Column]:
    """functions, classes, imports, ast_nodes and control_structures; import nodes are no nodes."""
    return {
        "functions": _count(("FunctionDef",)),
        "classes": _count(("ClassDef",)),
        "imports": F.col("imports"),
        "ast_nodes": F.size("nodes"),
        "control_structures": _count(CONTROL_KINDS),
    }


def depth() -> Column:
    """Deepest nesting; function and class nodes stand for two levels."""
    return F.coalesce(F.array_max(F.transform("nodes", lambda n: n["depth"])), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, value: total + value)


def cyclomatic() -> Column:
    """Sum of the complexity of top-level functions, classes and their methods.

    A function counts 1 and its branches; functions inside a function are left out. A class counts
    the mean over its methods and its own branches.
    """
    blocks = F.col("blocks")

    def one(block: Column) -> Column:
        return block["decisions"] + 1

    def of(parent: Column | int, kind: str) -> Column:
        return F.filter(blocks, lambda b: (b["parent"] == parent) & (b["kind"] == kind))

    def of_class(block: Column) -> Column:
        methods = F.transform(of(block["block"], "function"), one)
        whole, n = one(block) + _total(methods), F.size(methods)
        mean = F.floor(whole / F.nullif(n, F.lit(0))).cast("int") + (n != 1).cast("int")
        return F.when(n == 0, whole).otherwise(mean + _total(methods))

    functions = F.transform(of(0, "function"), one)
    return _total(functions) + _total(F.transform(of(0, "class"), of_class))


def halstead_volume() -> Column:
    """N · log2(n) over operators and operands; operands are told apart by function."""
    ops = F.flatten(F.transform("operators", lambda o: o["names"]))
    operands = F.flatten(
        F.transform("operators", lambda o: F.transform(o["operands"], lambda x: F.concat(o["scope"], F.lit("|"), x)))
    )
    length = F.size(ops) + F.size(operands)
    vocabulary = F.size(F.array_distinct(ops)) + F.size(F.array_distinct(operands))
    return F.when(vocabulary > 0, length * F.log2(vocabulary.cast("double"))).otherwise(F.lit(0.0))


def maintainability(with_docstrings: bool) -> Column:
    """Maintainability index, 0 to 100, from volume, complexity, statements and share of comments."""
    volume, statements = halstead_volume(), F.col("statements")
    comments = F.col("comment_tokens") + (F.col("docstring_lines") if with_docstrings else F.lit(0))
    share = F.when(F.col("source_lines") > 0, 100 * comments / F.col("source_lines")).otherwise(F.lit(0.0))
    index = (
        171
        - 5.2 * F.log(volume)
        - 0.23 * (cyclomatic() + 1)
        - 16.2 * F.log(statements)
        + 50 * F.sin(F.sqrt(2.46 * F.radians(share)))
    )
    bounded = F.least(F.greatest(100 * index / 171, F.lit(0.0)), F.lit(100.0))
    return F.when((volume > 0) & (statements > 0), bounded).otherwise(F.lit(100.0))


def tainted() -> Column:
    """Names that user input reaches, read in the order of the text: a copy of a name taints only if
    that name was tainted before. There are no scopes, and nothing clears a name."""

    def step(known: Column, assign: Column) -> Column:
        reached = assign["is_source"] | F.coalesce(F.array_contains(known, assign["copied_from"]), F.lit(False))
        return F.when(reached, F.array_union(known, assign["targets"])).otherwise(known)

    assigns = F.coalesce("assigns", F.array().cast(_ASSIGNS))
    return F.aggregate(assigns, F.array().cast(_TEXTS), step)


def nodes_table(facts: DataFrame, key: str = "file_id") -> DataFrame:
    """One row per node: key, seq, kind, depth."""
    return unnest_structs(facts, [key], "nodes", "seq")


def calls_table(facts: DataFrame, keep: tuple[str, ...] = ("file_id",)) -> DataFrame:
    """One row per call argument, with the call it belongs to and ``keep``; calls without arguments have none."""
    calls = unnest(facts, keep, "calls", "call", "seq")
    return calls.select(*keep, "seq", "call.func", "call.attr", F.posexplode_outer("call.args").alias("pos", "arg")).select(
        *keep, "seq", "func", "attr", "pos", "arg.*"
    )
