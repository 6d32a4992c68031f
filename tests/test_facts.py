"""Facts and what is read from them, against a plain walk of the tree."""

import ast

import pytest

from codesieve.operators import facts, features, heuristics
from codesieve.plans import syntax_expected as expected
from codesieve.plans.views import TEMPLATES

TEXTS = {
    "flow": "import os\nimport sys\nclass A(B):\n  def f(self, x):\n    for i in x:\n      if i and x or self:\n        return 1\n    else:\n      pass\n  def g(self):\n    try:\n      a = [y for y in x if y]\n    except ValueError:\n      pass\n    except KeyError:\n      pass\n",
    "async": "async def f():\n  async with a as b:\n    async for c in d:\n      assert c if d else e\n",
    "nested": "def f():\n  def g():\n    while x:\n      pass\n  with open(p) as h:\n    return lambda: 1 if a else 2\n",
    "match": "def f(x):\n  match x:\n    case 1:\n      pass\n    case [a, b]:\n      pass\n    case _:\n      pass\n",
    "empty": "",
    "doc": '"""one\ntwo\nthree"""\nx = 1  # note\n\n# alone\n',
}


class Counter(ast.NodeVisitor):
    def __init__(self):
        self.nodes = self.control = self.functions = self.classes = self.imports = 0
        self.deep = self.deepest = 0

    def visit(self, node):
        if isinstance(node, (ast.Import, ast.ImportFrom)):
            self.imports += 1
            return
        self.nodes += 1
        self.functions += type(node) is ast.FunctionDef
        self.classes += type(node) is ast.ClassDef
        self.control += type(node) in (ast.If, ast.For, ast.While, ast.Try, ast.With)
        step = 2 if type(node) in (ast.FunctionDef, ast.ClassDef) else 1
        self.deep += step
        self.deepest = max(self.deepest, self.deep)
        for child in ast.iter_child_nodes(node):
            self.visit(child)
        self.deep -= step


@pytest.fixture(scope="module")
def known(spark):
    rows = [(i, text) for i, text in enumerate(TEXTS.values())]
    files = facts.with_facts(spark.createDataFrame(rows, "file_id bigint, code string"))
    columns = {**facts.node_counts(), "depth": facts.depth(), "complexity": facts.cyclomatic()}
    picked = files.select("file_id", "parse_ok", *[c.alias(n) for n, c in columns.items()])
    names = list(TEXTS)
    return {names[r.file_id]: r for r in picked.collect()}


@pytest.mark.parametrize("name", TEXTS)
def test_counts_equal_a_walk(known, name):
    seen = Counter()
    seen.visit(ast.parse(TEXTS[name]))
    row = known[name]
    assert (row.ast_nodes, row.control_structures, row.functions, row.classes, row.imports, row.depth) == (
        seen.nodes,
        seen.control,
        seen.functions,
        seen.classes,
        seen.imports,
        seen.deepest,
    )


def test_complexity(known):
    # f: 1 + for, its else, if, and, or = 6; g: 1 + two handlers + comprehension with its test = 5.
    # The class has 1 + 6 + 5 = 12 over two methods: 6, and one more for having several.
    assert known["flow"].complexity == 6 + 5 + 7
    assert known["async"].complexity == 3
    assert known["nested"].complexity == 2
    assert known["match"].complexity == 3
    assert known["empty"].complexity == 0


@pytest.mark.parametrize("text", ["def x(:", "a\0b", None, "(" * 3000])
def test_unparsable_texts_are_no_error(text):
    assert facts.file_facts(text)["parse_ok"] is False


def judge(spark, text, match="literal"):
    files = facts.with_facts(spark.createDataFrame([(1, text)], "file_id bigint, code string"))
    return heuristics.with_heuristics(heuristics.with_taint(files), match).first()


TAINT = [
    ("a = input()", ["a"]),
    ("a = b = input()", ["a", "b"]),
    ("a = int(input('x'))\nb = a\nc = b", ["a", "b", "c"]),
    ("b = a\na = input()", ["a"]),
    ("a, b = input(), 1\na += input()\nc: int = input()", []),
    ("a = request.args.get('q') + 'x'", []),
    ("def f():\n  a = request.form.get('q')\ndef g():\n  b = a", ["a", "b"]),
]


@pytest.mark.parametrize("text, wanted", TAINT)
def test_taint_order(spark, text, wanted):
    assert judge(spark, text).tainted == wanted


SINKS = [
    ("a = input()\ncur.execute(a)", "literal", ["sql_injection"]),
    ("a = input()\ncur.execute('x' + a)\ncur.executemany(f'{a}')", "literal", ["sql_injection"] * 2),
    ("a = input()\ncur.execute('x', a)\ncur.execute(g(a))\nexecute(a)", "literal", []),
    ("a = input()\nos.system(a)", "literal", []),
    ("a = input()\nos.system(a)\nsubprocess.run(a, b, c + a)", "intended", ["command_injection"] * 3),
    ("a = input()\nos.popen(a)", "literal", ["path_traversal"]),
    ("a = input()\nopen('x', a)\nopen(b)\nopen()", "literal", []),
    ("x = 1\napp.run(debug=True)", "literal", ["debug_mode_enabled"]),
    ("def f(x):\n  return f'<b>{x}</b>'", "literal", ["xss_reflected"]),
    ("def f(x:", "literal", ["syntax_error"]),
]


@pytest.mark.parametrize("text, match, wanted", SINKS)
def test_sinks(spark, text, match, wanted):
    assert [h.name for h in judge(spark, text, match).heuristics] == wanted


def test_docstrings_count_as_comments_on_request(spark):
    files = spark.createDataFrame([(1, TEXTS["doc"])], "file_id bigint, code string")
    row = facts.with_facts(files).first()
    assert (row.comment_tokens, row.source_lines, row.docstring_lines) == (2, 1, 3)


def test_full_table_has_49_features(spark, small):
    from codesieve.plans.syntax_queries import feat_49

    table = feat_49(spark, small)
    assert len(table.columns) == 49 + 3
    assert len(features.FEATURES_49) == len(set(features.FEATURES_49)) == 49
    assert table.where("vuln_sql_injection = 1 AND vuln_path_traversal = 1 AND tainted_vars_count = 2").count() > 0


@pytest.mark.parametrize(
    "code, ways",
    [
        ("if a: pass", 1),
        ("for a in b: pass\nelse: pass", 2),
        ("while a and b or c: pass", 3),
        ("try: pass\nexcept A: pass\nexcept B: pass\nelse: pass\nfinally: pass", 3),
        ("x = [a for a in b if a if b]", 3),
        ("match a:\n  case 1: pass\n  case x if x > 1: pass\n  case _: pass", 2),
        ("match a:\n  case [1, x]: pass\n  case _ if a: pass", 2),
        ("with a: pass", 0),
    ],
)
def test_ways_through_nodes_by_hand(code, ways):
    assert sum(facts._decisions(node) for node in facts.ast.walk(facts.ast.parse(code))) == ways


@pytest.mark.parametrize(
    "code, operators, operands",
    [
        ("a + b - a", ["Sub", "Add"], 3),
        ("x += -1", ["Add", "USub"], 3),
        ("a < b <= c", ["Lt", "LtE"], 3),
        ("not (a and 'a')", ["Not", "And"], 2),
        ("1 + 1.0 + True + a.b", ["Add", "Add", "Add"], 6),
    ],
)
def test_operators_and_operands_by_hand(code, operators, operands):
    """Distinct operands: equal spellings count once, compound ones each."""
    found = [facts._operation(n) for n in facts.ast.walk(facts.ast.parse(code))]
    found = [f for f in found if f]
    assert sorted(type(o).__name__ for f in found for o in f[0]) == sorted(operators)
    assert len({facts._operand(o) for f in found for o in f[1]}) == operands


class Halstead(ast.NodeVisitor):
    """Operators, and operands by the function they stand in, counted kind by kind."""

    def __init__(self):
        self.scope, self.signs, self.operands = "", [], []

    def visit_FunctionDef(self, node):
        outer, self.scope = self.scope, node.name
        self.generic_visit(node)
        self.scope = outer

    def note(self, signs, operands):
        self.signs += [type(s).__name__ for s in signs]
        for o in operands:
            spelled = o.id if isinstance(o, ast.Name) else o.attr if isinstance(o, ast.Attribute) else o.value if isinstance(o, ast.Constant) else o
            self.operands.append((self.scope, type(spelled), spelled))

    def generic_visit(self, node):
        if isinstance(node, ast.BinOp):
            self.note([node.op], [node.left, node.right])
        elif isinstance(node, ast.UnaryOp):
            self.note([node.op], [node.operand])
        elif isinstance(node, ast.BoolOp):
            self.note([node.op], node.values)
        elif isinstance(node, ast.AugAssign):
            self.note([node.op], [node.target, node.value])
        elif isinstance(node, ast.Compare):
            self.note(node.ops, [node.left, *node.comparators])
        super().generic_visit(node)


@pytest.mark.parametrize("slot, length, vocabulary", expected.AST_HALSTEAD)
def test_halstead_counts_of_the_fixed_bodies(slot, length, vocabulary):
    walk = Halstead()
    walk.visit(ast.parse(TEMPLATES[slot][3].replace("¶", "\n").replace("{id}", "7")))
    assert len(walk.signs) + len(walk.operands) == length
    assert len(set(walk.signs)) + len(set(walk.operands)) == vocabulary
