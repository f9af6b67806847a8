"""Schema validation, cluster scratch folders and file sinks."""

import pytest

from faultlake import session
from faultlake.operators import envelope as E
from faultlake.operators import validation as V
from faultlake.sources import files

SCHEMA = {"$defs": {"id": {"type": "string", "pattern": "^[0-9a-f]{4}$"}}, "type": "object", "required": ["id", "kind"], "additionalProperties": False, "properties": {
    "id": {"$ref": "#/$defs/id"}, "kind": {"enum": ["a", "b"]}, "n": {"type": ["integer", "null"], "minimum": 1}, "parts": {"type": "array", "minItems": 1, "items": {"type": "object", "required": ["x"], "properties": {"x": {"type": "number"}}}},
    "either": {"anyOf": [{"type": "string"}, {"type": "boolean"}]}, "fixed": {"const": 2}}}
CASES = [
    ('{"id": "00ff", "kind": "a", "n": 3, "parts": [{"x": 1.5}], "either": true, "fixed": 2}', []),
    ('{"id": "zz", "kind": "c", "more": 1}', ["(root):  Additional properties are not allowed ('more' was unexpected)", "id:  'zz' does not match '^[0-9a-f]{4}$'", "kind:  'c' is not one of ['a', 'b']"]),
    ('{"id": 5, "n": 0, "parts": [{"x": 1}, {}, {"x": true}]}', ["(root):  'kind' is a required property", "id:  5 is not of type 'string'", "n:  0 is less than the minimum of 1", "parts  >  1:  'x' is a required property", "parts  >  2  >  x:  True is not of type 'number'"]),
    ('{"id": "00ff", "kind": "a", "parts": [], "either": 1, "fixed": 3, "n": 1.5}', ["either:  1 is not valid under any of the given schemas", "fixed:  2 was expected", "n:  1.5 is not of type 'integer', 'null'", "parts:  [] is too short"]),
    ("[]", ["(root):  [] is not of type 'object'"]), (None, ["(root):  None is not of type 'object'"])]


@pytest.mark.parametrize("text, want", CASES)
def test_messages(text, want):
    assert V.messages(text, SCHEMA) == want


def test_odd_documents_and_schemas(spark):
    assert V.messages("{", SCHEMA)[0].startswith("(root):  no valid JSON")
    with pytest.raises(ValueError):
        list(V.errors_of({}, {"oneOf": []}))
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    assert [r.e for r in df.select(V.schema_errors(df.t, SCHEMA).alias("e")).collect()] == [w for _, w in CASES]


def test_no_local_scratch_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Fake:
        def __init__(self, master):
            self.sparkContext = self
            self.master, self.conf = master, Conf()

        def getConf(self):
            return Conf()

    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,3000]"):
        with pytest.raises(ValueError):
            session.scratch_dir(Fake(master))


def test_images_and_manuals_as_files(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    rows = [("a.pdf", b"one"), ("b.PDF", b"two"), ("a.pdf", b"one"), ("c.txt", b"x")]
    E.write_images(spark.createDataFrame(rows, "name string, content binary"), folder)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a.pdf", "b.PDF", "c.txt"]
    assert [r.stem for r in files.one_manual(spark, f"{folder}/a.pdf").collect()] == ["a"]
    with pytest.raises(ValueError):
        files.one_manual(spark, f"{folder}/c.txt")
    with pytest.raises(ValueError):
        files.manual_files(spark, folder, "*.xyz")


def test_logging_to_a_file(tmp_path):
    import logging

    root = logging.getLogger()
    before = list(root.handlers), root.level
    session.configure_logging("info", str(tmp_path / "run.log"))
    logging.getLogger("site").info("Saved %d articles", 3)
    logging.getLogger("site").debug("not this")
    own = [h for h in root.handlers if h not in before[0]]
    for h in own:
        h.close()
        root.removeHandler(h)
    root.setLevel(before[1])
    text = (tmp_path / "run.log").read_text()
    assert text.endswith("INFO:site:Saved 3 articles\n") and "not this" not in text
