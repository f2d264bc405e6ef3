import pytest

from marketsignals.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return build_session(master="local[*]", shuffle_partitions=8)


def passage(seed, n):
    """n words that follow from the seed."""
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 9973}" for i in range(n))


# Nulls, empty and blank texts, ties, repeated rows, copies, shared passages, long and non-ASCII texts.
EDGE = [
    (1, passage(1, 120)), (2, passage(1, 120)), (3, passage(1, 119) + " other"), (3, passage(1, 119) + " other"),
    (4, None), (5, ""), (6, " \t\n\x0b\x0c\r "), (7, "one"), (8, "One"), (9, "one two"), (10, None),
    (11, passage(2, 50) + "\n" + passage(1, 60) + "\n" + passage(3, 50)),
    (12, passage(3, 34)), (13, passage(3, 35)), (14, "a " * 300), (15, "b b b b b b b b b b b"),
    (16, "né à ça " * 40 + passage(4, 40)), (17, "né à ça " * 40 + passage(4, 40).upper()),
    (None, passage(5, 80)), (None, passage(5, 80)), (20, passage(5, 80)), (21, passage(6, 20_000)),
    (22, passage(6, 20_000) + " tail"), (23, "x" * 500), (24, "x" * 99), (25, "  nbsp joined words   here"),
    (-3, passage(7, 60)), (30, passage(7, 60)), (31, "日本語" * 60), (32, "日本語" * 61), (33, "tab\tand\x0bmore\x1cfs\x85nel"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge texts with extra columns whose names the operators use inside."""
    rows = [(d, t, "en", None if i % 7 == 0 else f"s{i % 5}", len(t or ""), i, "k", [i], "row") for i, (d, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, k1 int, h string, "
                                       "size array<int>, row string")


@pytest.fixture(scope="session")
def edge_dir(spark, edge, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edge"))
    edge.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage(2, 30)), (2, passage(3, 12)), (2, passage(3, 12)), (3, "one two"), (4, None), (5, ""),
                           (6, "b"), (None, passage(5, 9)), (10, passage(5, 40)), (7, "!!!")],
                          "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "labels", "pages", "conversations"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="session")
def sf_rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def got(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def same(df, want, *cols):
    a, b = got(df, *cols), sorted(want, key=repr)
    assert len(a) == len(b)
    assert [(x, y) for x, y in zip(a, b) if x != y][:3] == []
