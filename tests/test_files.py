"""CSV exports, TSV products and the jobs from files to files."""

import json

import pandas as pd
import pytest
from pyspark.errors import PySparkException

from postloom import registry
from postloom.__main__ import main
from postloom.schemas import POSTS, PRODUCTS
from postloom.sources import exports, products
from postloom.operators.splits import Splits
from postloom.plans import jobs
from postloom.session import store
from postloom.sources.products import preview, read_lines, read_tsv, replace_product, write_lines, write_packed, write_tsv

LINES = [
    "extra_before,id,user_id,subject_id,title,desc,praise_count,reply_count,forward_count,star_count,share_count,create_time",
    "x,1,5,7,plain,text,1,2,3,4,5,100",
    'x,2,5,7,"quoted, comma","doubled ""quotes"" and a\nline break",1,2,3,4,5,100',
    "x,3,5,7,short line",
    "x,4,5,7,too long,text,1,2,3,4,5,100,more",
    "x,5,5,7,too long with an empty last field,text,1,2,3,4,5,100,",
    "x,6,,NA,null,None,nan,N/A,,NULL,5,100",
    "x,7,5,7, blanks ,  two  ,1,2,3,4,5,100.0",
    'x,8,5,7,"","{""a"": ""\\""b""}",1,2,3,4,5,100',
    "x,9,5,7,ends short,text,1,2,3,4,",
    'x,10,5,7,"too long, quoted","a\nb",1,2,3,4,5,100,"x,y",z',
]


@pytest.fixture(scope="module")
def posts_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("in") / "posts.csv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def plain(value):
    return None if pd.isna(value) else value


def test_lenient_scan_equals_pandas(spark, posts_csv):
    want = pd.read_csv(posts_csv, on_bad_lines="skip")[list(POSTS)]
    got = exports.read_posts(spark, posts_csv).orderBy("id").collect()
    assert [[plain(v) for v in row] for row in want.itertuples(index=False)] == [list(r) for r in got]
    assert [r["id"] for r in got] == [1, 2, 3, 6, 7, 8, 9]


def test_lenient_scan_when_pruned(spark, posts_csv):
    df = exports.read_posts(spark, posts_csv)
    assert df.count() == 7
    assert sorted(r[0] for r in df.select("id").collect()) == [1, 2, 3, 6, 7, 8, 9]


def test_strict_scan_raises_on_long_lines_only(spark, posts_csv, tmp_path):
    with pytest.raises(PySparkException):
        exports.read_posts(spark, posts_csv, strict=True).collect()
    path = tmp_path / "ok.csv"
    path.write_text("\n".join(line for line in LINES if "too long" not in line) + "\n", encoding="utf-8")
    assert exports.read_posts(spark, str(path), strict=True).count() == 7


def test_tsv_round_trip(spark, tmp_path):
    rows = [
        (1, ' "quoted"\ttab\nbreak '), (2, ""), (3, None), (4, "NA"), (5, 'back\\slash \\" quote'), (6, "  blanks  "),
        (7, ","), (8, '"'), (9, "帖子"),
    ]
    path = str(tmp_path / "lists")
    write_tsv(spark.createDataFrame(rows, "content_id long, inter_list string").coalesce(1), path)
    want = [(i, None if t in ("", "NA") else t) for i, t in rows]
    assert sorted((tuple(r) for r in read_tsv(spark, path, "inter_list").collect()), key=lambda r: r[0]) == want
    file = next((tmp_path / "lists").glob("part-*"))
    in_pandas = pd.read_csv(file, sep="\t").sort_values("content_id")
    assert [(int(r[0]), plain(r[1])) for r in in_pandas.itertuples(index=False)] == want


def test_lines_round_trip_and_split(spark, tmp_path):
    rows = [
        (1, ' "quoted"\ttab\nbreak\r\n '), (2, ""), (3, None), (4, "NA"), (5, 'back\\slash \\" quote \\n'), (6, "  blanks  "),
        (7, ","), (8, '"'), (9, "帖子"), (10, "100% %0A %250A%"), (11, "nul \0 end"), (12, "#x"), (13, "\u2028\x0b\x85"),
    ]
    path = str(tmp_path / "lists")
    write_lines(spark.createDataFrame(rows, "content_id long, inter_list string").coalesce(1), path)
    want = [(i, None if t in ("", "NA") else t) for i, t in rows]
    assert sorted((tuple(r) for r in read_lines(spark, path, "inter_list").collect()), key=lambda r: r[0]) == want
    many = spark.range(20_000).selectExpr("id AS content_id", "concat('a\nb', id, '\t') AS inter_list")
    write_lines(many.coalesce(1), f"{path}-large")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        large = read_lines(spark, f"{path}-large", "inter_list")
        assert len(large.inputFiles()) == 1 and large.rdd.getNumPartitions() >= 2
        assert large.exceptAll(many).isEmpty() and large.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_packed_lines_are_small_and_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    """What `tsv_tier` writes: rows that repeat their text take a fraction of the lines' bytes."""
    monkeypatch.setattr(products, "ROWS_PER_PACKED_FILE", 300)
    rows = spark.range(1_000).selectExpr("id AS content_id", "concat(repeat('a\nb \t%', 200), id) AS inter_list").coalesce(1)
    write_lines(rows, f"{tmp_path}/plain")
    write_packed(rows, f"{tmp_path}/packed")
    size = {name: sum(f.stat().st_size for f in (tmp_path / name).glob("part-*")) for name in ("plain", "packed")}
    assert size["packed"] < size["plain"] / 10 and len(list((tmp_path / "packed").glob("part-*.gz"))) == 4
    found = read_lines(spark, f"{tmp_path}/packed", "inter_list")
    assert found.exceptAll(rows).isEmpty() and found.count() == 1_000
    written = []
    monkeypatch.setattr(products, "write_packed", lambda *a: written.append(a) or write_packed(*a))
    registry.queries()["tsv_tier"](spark, "/root/testdata/sf0.001")
    assert len(written) == 1


def test_a_product_is_replaced_by_renames(spark, tmp_path):
    path = str(tmp_path / "product")
    replace_product(spark.range(5), path)
    # The new product may be made of the old one.
    replace_product(spark.read.parquet(path).selectExpr("id + 10 AS id"), path)
    assert sorted(r[0] for r in spark.read.parquet(path).collect()) == [10, 11, 12, 13, 14]
    with pytest.raises(PySparkException):
        replace_product(spark.read.parquet(path).selectExpr("raise_error('no') AS id"), path)
    assert spark.read.parquet(path).count() == 5
    replace_product(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def fanned(spark, rows, out, **options):
    contract = "user_id long, topic_id long, desc string, genre_id long, introduction string, comment int, forward int, thumb int, detail int, neg int, created_at long"
    frame = spark.createDataFrame(rows, f"{contract}, block int, id long, content_num long")
    jobs.fan_out(Splits(store(frame, "rows"), **options), out)


def test_fan_out_spreads_a_hot_user(spark, tmp_path):
    """A third of the rows in one user: no file holds far more rows than the others, and files follow the order."""
    rows = []
    for i in range(9_000):
        user, block = (50 if i % 3 == 0 else i % 100), i % 2
        rows.append((user, 1, f"text {i}", 1, "i", 0, 0, 1 - block, 0, block, 1_000 + (i * 7) % 977, block, i, user % 4))
    out = str(tmp_path / "out")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fanned(spark, rows, out, tiers=(1, 2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "out" / "content_with_topiccnt").glob("part-*"))
    found = [pd.read_parquet(f)[["neg", "user_id", "created_at"]].values.tolist() for f in files]
    sizes = sorted(len(f) for f in found)
    assert len(files) == 8 and sizes[-1] < 2 * sizes[4]
    assert sum(found, []) == sorted([r[9], r[0], r[10]] for r in rows)
    tiers = spark.read.parquet(f"{out}/bt")
    assert {r["top"]: r["count"] for r in tiers.groupBy("top").count().collect()} == {2: sum(r[13] > 2 for r in rows), 1: sum(r[13] == 2 for r in rows)}
    parts = spark.read.parquet(f"{out}/splits")
    assert {(r["k"], r["part"]) for r in parts.select("k", "part").distinct().collect()} == {(k, p) for k in (1, 2) for p in ("train", "dev")}
    assert not list((tmp_path / "out").glob("_fan*"))
    with pytest.raises(FileExistsError):
        fanned(spark, rows, out)


def test_fan_out_of_nothing(spark, tmp_path):
    fanned(spark, [], str(tmp_path / "out"))
    assert spark.read.parquet(f"{tmp_path}/out/content_with_topiccnt").count() == 0
    fanned(spark, [(1, 1, "t", 1, "i", 0, 0, 1, 0, 0, 5, 0, 1, 0)], str(tmp_path / "one"))
    assert spark.read.parquet(f"{tmp_path}/one/content_with_topiccnt").count() == 1
    assert (tmp_path / "one" / "bt").is_dir() and (tmp_path / "one" / "splits").is_dir()


def test_typed_read_is_strict_on_missing_numbers(spark, tmp_path):
    path = str(tmp_path / "log")
    write_tsv(spark.createDataFrame([(1, None, "{}", 5)], "user_id long, event_id long, event_data string, created_at long"), path)
    with pytest.raises(PySparkException):
        read_tsv(spark, path, "useract_all").collect()
    assert tuple(read_tsv(spark, path, "useract_all", strict=False).first()) == (1, None, "{}", 5)


def test_preview(spark):
    assert [r[0] for r in preview(spark.range(100).repartition(7), ["id"], 5).collect()] == [0, 1, 2, 3, 4]


@pytest.fixture(scope="module")
def app(tmp_path_factory):
    """A small app: users 0 to 11, posts 1 to 20, topics 1 to 4."""
    folder = tmp_path_factory.mktemp("app")
    codes = [254, 257, 258, 262, 100, 100, 100]
    log, row = [], 0
    for user in range(12):
        for i in range(20 + user):
            row += 1
            log.append({
                "id": row, "device_id": "d", "user_id": user, "event_id": codes[(user * 3 + i) % 7],
                "event_data": json.dumps({"content_id": (user * i) % 23, "note": 'a, "b"'}), "created_at": 1000 + i,
            })
    pd.DataFrame(log).to_csv(folder / "log.csv", index=False)
    pd.DataFrame([
        {"id": p, "user_id": p % 5, "subject_id": p % 5 + 1, "title": f"t {p}", "desc": f"text\n{p % 9}", "praise_count": p,
         "reply_count": 1, "forward_count": 0, "star_count": 0, "share_count": 0, "create_time": p, "other": "x"}
        for p in range(1, 21)
    ]).to_csv(folder / "posts.csv", index=False)
    pd.DataFrame([
        {"id": t, "title": f"topic {t}", "introduction": "in tro", "genre_id": t % 2, "create_time": 5} for t in range(1, 5)
    ]).to_csv(folder / "topics.csv", index=False)
    pd.DataFrame([{"id": 1, "sex": None, "zan_count": 2.5, "name": "n"}]).to_csv(folder / "users.csv", index=False)
    return folder


def test_jobs_from_csv_to_tsv(spark, app, tmp_path, capsys):
    out = str(tmp_path)
    inputs = [f"--{n}={app}/{n}.csv" for n in ("log", "posts", "topics")]
    main(["user", f"--out={out}", "--form=tsv", f"--users={app}/users.csv"])
    main(["activity", f"--out={out}", "--form=tsv", "--cap=30", "--cohort=4", inputs[0]])
    main(["content", f"--out={out}", "--form=tsv", "--cap=30", *inputs])
    main(["content", f"--out={out}/cut", "--pieces", "--cap=30", *inputs])
    main(["interactions", f"--out={out}", "--form=tsv", "--wide", *inputs])
    main(["interactions", f"--out={out}/cut", "--pieces", *inputs])
    printed = [line.split() for line in capsys.readouterr().out.splitlines()]
    counts = dict(printed)

    def product(path, contract, strict=True):
        return read_tsv(spark, f"{out}/{path}", contract, strict)

    assert [tuple(r) for r in product("user", "user").collect()] == [(1, 0, 2)]
    assert {r[0] for r in product("useract_all", "useract_all").select("user_id").collect()} == set(range(10))
    assert product("useract5k", "useract5k").select("user_id").distinct().count() == 4
    content = product("content", "content", strict=False)
    assert content.columns == list(PRODUCTS["content"]) and content.count() == 20
    assert product("content_with_author", "content_with_author", strict=False).where("user_id <> author_user_id").count() == 0
    n_rows = sum(20 + u for u in range(12))
    assert int(counts["log_rows"]) == int(counts["log_rows_with_user"]) == n_rows and counts["bad_json"] == "0"
    assert counts["users"] == "12" and counts["users_over_cap"] == "2" and ["users", "1"] in printed
    lists = {r["content_id"]: r["inter_list"] for r in product("inter_list", "inter_list").collect()}
    assert 0 not in lists
    without_post = [r[0] for r in spark.read.options(header=True).csv(f"{out}/inter_list_no_post").collect()]
    assert without_post == sorted(without_post, key=int)
    lists[0] = ",".join(without_post)
    cut = spark.read.parquet(f"{out}/cut/inter_list_pieces").orderBy("content_id", "part").collect()
    assert {i: ",".join(r["inter_list"] for r in cut if r["content_id"] == i) for i in {r["content_id"] for r in cut}} == lists
    assert all(r["num"] == len(r["inter_list"].split(",")) for r in cut)
    assert not (tmp_path / "cut" / "content").exists()

    whole = product("content_with_topiccnt", "content_with_topiccnt")
    assert whole.count() == int(counts["interactions"])
    for r in whole.collect():
        assert {r["comment"], r["forward"], r["thumb"], r["detail"], r["neg"]} <= {0, 1}
    ordered = ["user_id", "created_at"]
    tops = spark.read.options(header=True, sep="\t").csv(f"{out}/bt").select("user_id", "created_at", "neg", "top").collect()
    previous = None
    for k in range(1, 6):
        tier = product(f"bt_wide/k={k}", "bt").collect()
        assert len(tier) == int(counts[f"bt{k}"]) == sum(int(r["top"]) >= k for r in tops)
        assert all(r["content_num"] == len(r["content_list"].split(",")) > k for r in tier)
        keys = {(r["user_id"], r["created_at"], r["desc"], r["neg"]) for r in tier}
        assert previous is None or keys <= previous
        previous = keys
        train, dev = product(f"splits/k={k}/part=train", "train"), product(f"splits/k={k}/part=dev", "dev")
        test = product(f"test/k={k}", "test").collect()
        assert 0 < train.count() <= int(len(tier) * 0.8) and dev.count() <= int(len(tier) * 0.1)
        assert len({r["user_id"] for r in test}) == len(test)
        for file in (tmp_path / "splits" / f"k={k}" / "part=train").glob("part-*"):
            rows = pd.read_csv(file, sep="\t")[["neg", *ordered]]
            assert rows.equals(rows.sort_values(["neg", *ordered], kind="stable"))


    whole_lists = {r["user_id"]: r["content_list"] for r in product("content_with_interlist", "content_with_interlist").collect()}
    cut = spark.read.parquet(f"{out}/cut/content_with_interlist_pieces").orderBy("user_id", "part").collect()
    assert {u: ",".join(r["content_list"] for r in cut if r["user_id"] == u) for u in {r["user_id"] for r in cut}} == whole_lists
    truth = spark.read.parquet(f"{out}/cut/test_pieces").orderBy("k", "user_id", "part").collect()
    for k in range(1, 6):
        test = {r["user_id"]: r["content_list"] for r in product(f"test/k={k}", "test").collect()}
        assert {u: ",".join(r["content_list"] for r in truth if (r["k"], r["user_id"]) == (k, u)) for u in {r["user_id"] for r in truth if r["k"] == k}} == test
    assert not (tmp_path / "cut" / "content_with_interlist").exists()


def test_a_job_leaves_no_intermediate_tables(spark, app, tmp_path):
    from pathlib import Path

    from postloom.session import shared_folder

    before = set(Path(shared_folder(spark)).iterdir())
    main(["activity", f"--out={tmp_path}", "--cap=30", "--cohort=4", f"--log={app}/log.csv"])
    assert set(Path(shared_folder(spark)).iterdir()) <= before
    assert spark.read.parquet(f"{tmp_path}/useract5k").select("user_id").distinct().count() == 4


def test_content_is_strict_unless_told(spark, app, tmp_path, capsys):
    log = tmp_path / "log.csv"
    log.write_text((app / "log.csv").read_text() + '900,d,1,254,"{""content_id"": 1",5\n901,d,1,254,"{""content_id"": 2}x",5\n')
    inputs = [f"--log={log}", f"--posts={app}/posts.csv", f"--topics={app}/topics.csv"]
    with pytest.raises(PySparkException):
        main(["content", f"--out={tmp_path}/a", "--cap=99", *inputs])
    main(["content", f"--out={tmp_path}/b", "--cap=99", "--payloads=lenient", *inputs])
    assert "bad_json 1" in capsys.readouterr().out
    posts = tmp_path / "posts.csv"
    posts.write_text((app / "posts.csv").read_text().rstrip("\n") + "\n" + ",".join("7" * 13) + "\n")
    inputs[1] = f"--posts={posts}"
    with pytest.raises(PySparkException, match="too many fields"):
        main(["content", f"--out={tmp_path}/c", "--cap=99", "--payloads=lenient", *inputs])
    main(["content", f"--out={tmp_path}/d", "--cap=99", "--payloads=lenient", "--lenient-csv", *inputs])
    assert "posts_lines_left_out 1" in capsys.readouterr().out
