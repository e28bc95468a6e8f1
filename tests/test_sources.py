import pytest
from pyspark.sql import functions as F

from tallygrid.operators.employees import emp_clean
from tallygrid.operators.sales import sales_clean
from tallygrid.sources import schemas, scratch, sinks, tables


@pytest.fixture
def folder(spark):
    return scratch.fresh_folder(spark, "test")


def test_dirty_text_becomes_null_and_is_cleaned(spark, folder, rows_of):
    lines = ["id,name,age,city,salary,department,hire_date,status",
             "1,Ann,30,Zürich,10.5,Ops,2020-01-01,Active",
             "x,Bad,30,Rome,10.5,Ops,2020-01-01,Active",
             "id,name,age,city,salary,department,hire_date,status",
             "2,O'Neil,,Rome,abc,Ops,,Active"]
    spark.createDataFrame([(line,) for line in lines], "v string").coalesce(1).write.text(folder)
    for header in (True, False):
        got = rows_of(emp_clean(tables.read_employees(spark, folder, header)))
        assert got == [(1, "Ann", 30, "Zürich", 10.5, "Ops", "2020-01-01", "Active"),
                       (2, "O'Neil", None, "Rome", None, "Ops", None, "Active")]
    assert set(dict(tables.read_all_strings(spark, folder).dtypes).values()) == {"string"}


def test_sales_read_with_text_or_real_dates(spark, folder, make_sales, rows_of):
    df = make_sales({}, {"total_amount": None})
    sinks.write_with_header(df, folder)
    assert rows_of(tables.read_sales(spark, folder)) == rows_of(df)
    text = sales_clean(tables.read_sales(spark, folder, header=False))
    assert dict(text.dtypes)["sale_date"] == "string"
    assert rows_of(text, "sale_date") == [("2024-03-01",)] * 2


def test_writers_replace_what_is_there(spark, folder, make_emp, rows_of):
    for n in (3, 1):
        sinks.write_positional(make_emp(*[{}] * n), folder)
    assert tables.read_employees(spark, folder, header=False).count() == 1


def test_lines_keep_commas_and_quotes(spark, folder, rows_of):
    df = spark.createDataFrame([('a, "b" | c',)], "line string")
    sinks.write_lines(df, folder)
    assert rows_of(spark.read.text(folder)) == [('a, "b" | c',)]


def test_documents_keep_their_shape(spark, folder, rows_of):
    df = spark.createDataFrame([("1", ["a", "b"], None)], "_id string, preferences array<string>, "
                               "address struct<city: string>")
    sinks.write_documents(df, folder)
    assert rows_of(tables.read_collection(spark, folder, df.schema)) == rows_of(df)
    assert tables.read_collection(spark, folder).count() == 1


def test_arrays_cannot_go_to_comma_text(spark, folder):
    df = spark.range(1).select(F.array("id").alias("a"))
    with pytest.raises(Exception, match="(?i)unsupported"):
        sinks.write_with_header(df, folder)


def test_partitioned_table_prunes(spark, folder):
    df = spark.range(1000).select((F.col("id") % 5).cast("string").alias("k"), "id")
    sinks.write_table(df, folder, ["k"])
    picked = spark.read.parquet(folder).where("k = '3'")
    assert picked.count() == 200
    assert "PartitionFilters: [isnotnull(k" in picked._jdf.queryExecution().toString()


def test_one_file_and_sample(spark, folder, make_emp):
    sinks.write_with_header(make_emp({}, {}, {}).repartition(3), folder, one_file=True)
    assert tables.read_employees(spark, folder).inputFiles().__len__() == 1
    sinks.write_sample(make_emp(*[{}] * 9), folder, n=5)
    assert tables.read_employees(spark, folder).count() == 5


def test_views_profile_and_samples(spark, make_emp, rows_of):
    df = make_emp({}, {}, {}, {})
    tables.register({"staff": df})
    assert spark.sql("SELECT count(*) FROM staff").first()[0] == 4
    assert rows_of(tables.collection_profile({"a": df, "b": df.limit(1)})) == [("a", 4), ("b", 1)]
    assert tables.collection_samples({"a": df}, order="id").count() == 3
    assert tables.preview(df, 2, order=("id",)).count() == 2
    assert rows_of(tables.map_double(df, "age")) == [(35, 70)] * 4


def test_scratch_uses_the_named_folder_else_the_warehouse(spark):
    base = spark.conf.get(scratch.SETTING)
    assert scratch.fresh_folder(spark, "x").startswith(base)

    class Conf(dict):
        def get(self, name, default=None):
            return dict.get(self, name, default)

    class Cluster:
        conf = Conf({"spark.master": "yarn", "spark.sql.warehouse.dir": "hdfs://store/tables"})

    assert scratch.shared_base(Cluster()) == "hdfs://store/tables/scratch"


def test_schemas_cover_the_documents():
    assert [f.name for f in schemas.CUSTOMER_DOCUMENT][:3] == ["_id", "customer_id", "name"]
    assert "sale_info" in schemas.SALES_DOCUMENT.fieldNames()


@pytest.mark.parametrize("master,tables,refused", [
    ("spark://somewhere:7077", "file:///tmp/tables", True), ("yarn", "/tmp/tables", True), ("yarn", "hdfs://store/tables", False),
    ("local[2]", "file:///tmp/tables", False), ("local", "file:///tmp/tables", False), ("local-cluster[2,1,1024]", "file:///t", True)])
def test_scratch_is_not_on_a_local_disk_of_a_cluster(master, tables, refused):
    class Conf(dict):
        def get(self, name, default=None):
            return dict.get(self, name, default)

    class Session:
        conf = Conf({"spark.master": master, "spark.sql.warehouse.dir": tables})

    if refused:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch.shared_base(Session())
    else:
        assert scratch.shared_base(Session()) == f"{tables}/scratch"


@pytest.mark.parametrize("header", [True, False])
def test_cells_come_back_as_they_were(spark, folder, rows_of, header):
    cells = ["  a ", '"x" said, ""', "\\b\\", "a\n b, c\n", "", None, " ", "r\rq", "r\r\nq", "\\", '"', '\\"', "\t", "é,日本"]
    df = spark.createDataFrame([(i, c, c) for i, c in enumerate(cells)], "id long, name string, note string")
    write = sinks.write_with_header if header else sinks.write_positional
    read = tables.read_with_header if header else tables.read_positional
    write(df, folder)
    assert rows_of(read(spark, folder, df.schema, line_breaks=True)) == rows_of(df)


def test_a_collection_is_replaced_through_its_format(spark, folder, rows_of):
    for n in (3, 2):
        df = spark.range(n).select(F.col("id").cast("string").alias("_id"), F.struct(F.col("id").alias("n")).alias("a"))
        sinks.write_collection(df, "orc", {"compression": "zlib"}, folder)
    assert rows_of(tables.read_collection(spark, folder, source="orc")) == rows_of(df)
