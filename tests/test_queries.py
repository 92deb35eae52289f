"""Every registered query against its DuckDB twin."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
OWN = [q for q in entry._own.QUERIES]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no generated tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", OWN)
def test_same_as_sql(spark, duck, tmp_path, name):
    entry.queries()[name](spark, SF).write.parquet(str(tmp_path / "out"))
    duck.execute(f"CREATE OR REPLACE TABLE got AS SELECT * FROM read_parquet('{tmp_path}/out/*.parquet')")
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return
    duck.execute(f"CREATE OR REPLACE TABLE want AS {sql}")
    kinds = lambda t: sorted(r[:2] for r in duck.execute(f"DESCRIBE {t}").fetchall())
    assert kinds("got") == kinds("want")
    cols = ", ".join(f'"{c}"' for c, _ in kinds("got"))
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.execute(f"SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b} LIMIT 3").fetchall() == []


def test_line_matching_is_brute_force(spark, tmp_path, rows):
    import difflib
    import random

    r = random.Random(3)
    words = ["".join(r.choice("aeinrst") for _ in range(r.randint(2, 7))) for _ in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    turns = []
    for conv in range(4):
        tails = [text(60) for _ in range(11)]
        # Equal first sentences before other texts, other first sentences before equal texts.
        for i, tail in enumerate(tails):
            turns.append((conv, 2 * i, "user", f"Same start. {tail}"))
            turns.append((conv, 2 * i + 1, "assistant", f"{text(3)}. {tails[(i + conv) % 11] if i % 3 else text(60)}"))
    turns += [(9, 0, "user", "Alone."), (10, 1, "assistant", "Alone.")]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    want = []
    for conv in range(4):
        a, b = ([t[3].lower() for t in sorted(turns) if t[0] == conv and t[2] == role] for role in ("user", "assistant"))
        pairs = sorted(((difflib.SequenceMatcher(None, x, y, False).ratio(), i, j) for i, x in enumerate(a) for j, y in enumerate(b)), reverse=True)
        while pairs and pairs[0][0] >= 0.45:
            _, i, j = pairs[0]
            want.append((conv, i, j))
            pairs = [p for p in pairs if p[1] != i and p[2] != j]
    assert len(want) > 20 and rows(entry.queries()["line_matching"](spark, str(tmp_path))) == sorted(want, key=repr)


def test_entry(spark):
    assert entry.entry(spark).columns == ["vec_id", "label", "score"]


def test_twins_have_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def same_as_sql(spark, tmp_path, name, **tables):
    """Whether a query over these tables gives the rows of its SQL, each as often."""
    con = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    got = entry.queries()[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    return sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and len(want) > 0


def test_keyframe_extraction_times_of_many_frames(spark, tmp_path):
    # 201 / 25 * 1000 is a little below 8,040 in double precision.
    vectors = [(i, 7, [float(1 + i % 3 * 40), float(i % 2), float(i % 5)]) for i in range(1, 420)]
    embeddings = spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>")
    signs = embeddings.selectExpr("vec_id", "label", "transform(embedding, (x, i) -> x * cast(if(vec_id % 2 = 0, 1, -1) as float)) as embedding")
    assert same_as_sql(spark, tmp_path, "keyframe_extraction", embeddings=signs)
