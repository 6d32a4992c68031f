"""What the syntax queries must find in each Python body of ``views.TEMPLATES``, by its slot.

The text behind a body is comments only, so every fact of the tree hangs on the slot alone; rules that search the whole text
may find more there and are written out in SQL. The rows were recorded from a run and
read against the bodies (names, calls, taint, findings, counts of definitions, imports and control structures); node
counts, depths and complexities are compared with a walk of the tree in the tests.
"""

from __future__ import annotations

# Rows per query, the slot first.

AST_FACTS = (
    (0, True, 15, 0, 1, 1, 3, 3),
    (1, True, 27, 0, 1, 3, 5, 5),
    (2, True, 50, 2, 4, 0, 8, 8),
    (11, False, 0, 0, 0, 0, None, None),
    (12, True, 82, 0, 9, 1, 13, 12),
    (13, True, 87, 1, 7, 2, 12, 12),
    (14, True, 102, 0, 6, 4, 15, 16),
    (15, True, 78, 2, 6, 1, 11, 11),
    (16, True, 56, 0, 4, 1, 8, 8),
)

AST_COUNTS = (
    (0, 1, 0, 1, 15, 0),
    (1, 1, 0, 1, 27, 1),
    (2, 1, 0, 1, 50, 1),
    (12, 1, 1, 1, 82, 0),
    (13, 1, 0, 1, 87, 0),
    (14, 2, 0, 1, 102, 4),
    (15, 1, 0, 2, 78, 1),
    (16, 0, 0, 0, 56, 0),
)

AST_DEPTH = (
    (0, 8),
    (1, 8),
    (2, 9),
    (12, 12),
    (13, 9),
    (14, 12),
    (15, 9),
    (16, 7),
)

AST_CYCLOMATIC = (
    (0, 1),
    (1, 2),
    (2, 1),
    (11, 0),
    (12, 4),
    (13, 1),
    (14, 7),
    (15, 2),
    (16, 0),
)

AST_TAINT = (
    (2, 'alias'),
    (2, 'name'),
    (13, 'user'),
    (15, 'name'),
    (15, 'other'),
)

AST_TAINT_FLAGS = (
    (0, 0, 0),
    (1, 0, 0),
    (2, 2, 1),
    (12, 0, 0),
    (13, 1, 1),
    (14, 0, 0),
    (15, 2, 1),
    (16, 0, 0),
)

AST_CONTAINS_TAINT = (
    (0, 0, 'os.system', 0, False),
    (1, 0, 'ValueError', 0, False),
    (2, 0, 'request.args.get', 0, False),
    (2, 1, 'cur.execute', 0, True),
    (2, 2, 'open', 0, True),
    (2, 3, 'pickle.load', 0, False),
    (12, 0, 'subprocess.call', 0, False),
    (12, 2, 'yaml.load', 0, False),
    (12, 3, 'marshal.loads', 0, False),
    (12, 4, 'random.choice', 0, False),
    (12, 5, 'eval', 0, False),
    (12, 6, 'exec', 0, False),
    (12, 7, 'compile', 0, False),
    (12, 7, 'compile', 1, False),
    (12, 7, 'compile', 2, False),
    (12, 8, 'hashlib.md5', 0, False),
    (13, 1, 'request.form.get', 0, False),
    (13, 2, 'cur.execute', 0, True),
    (13, 3, 'cur.execute', 0, True),
    (13, 4, 'cur.executemany', 0, True),
    (13, 4, 'cur.executemany', 1, False),
    (13, 5, 'os.system', 0, True),
    (13, 6, 'open', 0, True),
    (14, 1, 'inner', 0, False),
    (14, 2, 'isinstance', 0, False),
    (14, 2, 'isinstance', 1, False),
    (14, 3, 'TypeError', 0, False),
    (14, 4, 'html.escape', 0, False),
    (14, 5, 'cur.execute', 0, False),
    (14, 5, 'cur.execute', 1, False),
    (15, 0, 'DES.new', 0, False),
    (15, 0, 'DES.new', 1, False),
    (15, 1, 'etree.fromstring', 0, False),
    (15, 2, 'input', 0, False),
    (15, 3, 'subprocess.run', 0, True),
    (15, 4, 'open', 0, False),
    (15, 5, 'os.remove', 0, True),
    (16, 0, 'print', 0, False),
    (16, 1, 'open', 0, False),
    (16, 2, 'cursor.execute', 0, False),
)

AST_SQLI = (
    (2, 0, 'sql_injection', 'CRITICAL', "Variable 'alias' controlada por usuario usada en SQL execution."),
    (13, 0, 'sql_injection', 'CRITICAL', 'Concatenación peligrosa detectada dentro de execute()'),
    (13, 1, 'sql_injection', 'CRITICAL', 'F-string peligrosa en ejecución SQL'),
    (13, 2, 'sql_injection', 'CRITICAL', "Variable 'user' controlada por usuario usada en SQL execution."),
)

AST_CMDI = (
    (13, 'intended', 0, 'command_injection', 'CRITICAL', 'Llamada peligrosa: os.system recibe datos del usuario'),
    (15, 'intended', 0, 'command_injection', 'CRITICAL', 'Llamada peligrosa: subprocess.run recibe datos del usuario'),
)

AST_PATH = (
    (2, 0, 'path_traversal', 'HIGH', 'Llamada a open con path controlado por usuario'),
    (13, 0, 'path_traversal', 'HIGH', 'Llamada a open con path controlado por usuario'),
    (15, 0, 'path_traversal', 'HIGH', 'Llamada a os.remove con path controlado por usuario'),
)

#: What a body says that does not parse; the findings of the others are those of the tables above, behind those on the text.
AST_UNPARSABLE = ((11, 0, 'syntax_error', 'LOW', 'No se pudo analizar el AST'),)

#: Operators and operands of a body, all of them and the distinct ones, for its Halstead volume. Tests count them with a walk.
AST_HALSTEAD = (
    (0, 3, 3),
    (1, 9, 8),
    (2, 0, 0),
    (12, 3, 3),
    (13, 6, 5),
    (14, 10, 9),
    (15, 3, 3),
    (16, 3, 3),
)
