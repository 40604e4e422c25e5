import os

import pytest

from tickloom.operators import contract
from tickloom.plans import catalog
from tickloom.plans.sinks import setting
from tickloom.sources import contracts


def write(folder, text):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/contract.csv"
    with open(path, "wb") as out:
        out.write(text if isinstance(text, bytes) else text.encode())
    return path


def mapping(found):
    return {row.token: tuple(row)[1:3] for row in found.rows.collect()}


def test_derivative_file(spark, folder):
    path = write(folder, "N,1,99999,FUTSTK,HEAD,1\n"
                         "C,1, 45001 ,FUTSTK, ABC ,1459348200,x,y,z\n"
                         "C,1,45002,EQUITY,CASH,bad\n"
                         "C,1,45003,OPTIDX,\"A,B\",5\n"
                         "C,1,45004,FUTSTK,SHORT\n"
                         "\n"
                         "C,1,1000000,FUTSTK,FAR,5\r\n")
    found = contracts.read_fo_contract(spark, path)
    assert mapping(found) == {45001: ("ABC", 1459348200), 45003: ("A,B", 5)}
    assert found.row_count == 2 and found.byte_count > 0
    subset = contracts.read_fo_contract(spark, path, ("OPTIDX",))
    assert mapping(subset) == {45003: ("A,B", 5)}


def test_bad_bytes_are_dropped(spark, folder):
    path = write(folder, b"h\nC,1,45001,FUTSTK,AB\xffC,7\n")
    assert mapping(contracts.read_fo_contract(spark, path)) == {45001: ("ABC", 7)}


@pytest.mark.parametrize("line", ["C,1,x,FUTSTK,A,5", "C,1,5,FUTSTK,A,", "C,1,,FUTSTK,A,5"])
def test_bad_numbers_fail(spark, folder, line):
    path = write(folder, f"h\n{line}\n")
    with pytest.raises(Exception, match="bad "):
        contracts.read_fo_contract(spark, path).rows.collect()


CONFLICT = "h\nC,1,7,FUTSTK,A,5\nC,1,7,OPTSTK,A,5\nC,1,7,FUTIDX,B,6\nC,1,8,FUTSTK,A,5\nC,1,8,FUTSTK,A,5\n"


def test_conflicts(spark, folder):
    path = write(folder, CONFLICT)
    with pytest.raises(ValueError, match="token 7 maps inconsistently"):
        contracts.read_fo_contract(spark, path)
    first = contracts.read_fo_contract(spark, path, on_conflict="first")
    last = contracts.read_fo_contract(spark, path, on_conflict="last")
    assert mapping(first) == {7: ("A", 5), 8: ("A", 5)}
    assert mapping(last) == {7: ("B", 6), 8: ("A", 5)}
    sets = {row.token: sorted(row.instruments) for row in last.rows.collect()}
    assert sets == {7: ["FUTIDX", "FUTSTK", "OPTSTK"], 8: ["FUTSTK"]}
    clash = contract.conflicts(last.entries, ("symbol", "expiry")).collect()
    assert [(r.token, r.mappings, r.lines) for r in clash] == [(7, 2, 3)]
    assert {r.expiry: (r.tokens, r.symbols) for r in contract.expiry_profile(last.entries).collect()} == {5: (2, 1), 6: (1, 1)}
    assert {r.instrument: r.tokens for r in contract.tokens_per_instrument(last.entries).collect()} == {
        "FUTSTK": 2, "OPTSTK": 1, "FUTIDX": 1}


def test_empty_contract_fails(spark, folder):
    with pytest.raises(ValueError, match="no contract lines"):
        contracts.read_fo_contract(spark, write(folder, "h\nC,1,7,EQUITY,A,5\n"))
    with pytest.raises(ValueError, match="no contract lines"):
        contracts.read_fo_contract(spark, write(folder, ""))


@pytest.mark.parametrize("first, extra", [
    ("1711500000", {}), (" 1711500000 ,x", {}), ("C,1,9,EQUITY,FIRST,0,0,EQ", {9: ("FIRST", "EQ")}),
    ("1711500000,1,9,EQUITY,FIRST,0,0,EQ", {}), ("C,1,bad,EQUITY,FIRST,0,0,EQ", {}), ("C,1,9,EQUITY", {})])
def test_cash_first_line(spark, folder, first, extra):
    path = write(folder, f"{first}\nC,1,2263,EQUITY,BANK,0,0,EQ\nC,1,x,EQUITY,BAD,0,0,EQ\n"
                         "C,1,2263,EQUITY,OTHER,0,0,BE\n123,1,5,EQUITY,KEPT,0,0,\nC,1,6,EQUITY,SEVEN,0,0\n")
    assert mapping(contracts.read_cm_contract(spark, path)) == {2263: ("BANK", "EQ"), 5: ("KEPT", ""), **extra}


def test_line_order_holds_across_blocks(spark, folder):
    lines = ["C,1,5,FUTSTK,HEAD,1"] + [f"C,1,{i % 10},FUTSTK,S{i},{i}" for i in range(2000)]
    path = write(folder, "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert contracts.numbered_lines(spark, path).rdd.getNumPartitions() > 3
        first = contracts.read_fo_contract(spark, path, on_conflict="first")
        last = contracts.read_fo_contract(spark, path, on_conflict="last")
        assert mapping(first) == {i: (f"S{i}", i) for i in range(10)}
        assert mapping(last) == {i: (f"S{1990 + i}", 1990 + i) for i in range(10)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_top_series_counts_lines_that_agree_with_the_first(spark):
    rows = [(1, 1, "A", "EQ"), (2, 1, "A", "BE"), (3, 1, "A", "EQ"), (4, 2, "B", "BE"), (5, 3, "C", "SM"), (6, 4, "D", "SM")]
    df = spark.createDataFrame(rows, "line_key bigint, token bigint, symbol string, series string")
    assert [tuple(r) for r in contract.top_series(df).collect()] == [("BE", 1), ("EQ", 2), ("SM", 2)]
    assert [tuple(r) for r in contract.top_series(df, 2).collect()] == [("EQ", 2), ("SM", 2)]


def test_a_folder_is_read_file_by_file_in_order_of_names(spark, folder):
    os.makedirs(folder)
    for name, lines in (("part-0", ["C,1,5,FUTSTK,HEAD,1", "C,1,7,FUTSTK,A,1"]), ("part-1", [f"C,1,7,FUTSTK,B{i},2" for i in range(50)] + ["C,1,8,FUTSTK,C,3"]),
                        ("part-2", ["C,1,7,FUTSTK,Z,9"])):
        with open(f"{folder}/{name}", "w") as out:
            out.write("\n".join(lines) + "\n")
    assert mapping(contracts.read_fo_contract(spark, folder, on_conflict="first")) == {7: ("A", 1), 8: ("C", 3)}
    assert mapping(contracts.read_fo_contract(spark, folder, on_conflict="last")) == {7: ("Z", 9), 8: ("C", 3)}


def test_contract_lines_are_written_in_order_by_several_tasks(spark):
    lines = spark.range(4000).selectExpr("3999 - id AS line_key", "concat('C,1,', (3999 - id) % 10, ',FUTSTK,S', 3999 - id, ',5') AS value").repartition(5)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        path = catalog.written_lines(lines, "first line").removeprefix("file:")
    files = sorted(name for name in os.listdir(path) if name.startswith("part-"))
    assert len(files) > 2
    read = [line for name in files for line in open(f"{path}/{name}").read().splitlines()]
    assert read == ["first line"] + [f"C,1,{i % 10},FUTSTK,S{i},5" for i in range(4000)]
    assert mapping(contracts.read_fo_contract(spark, path, on_conflict="first")) == {i: (f"S{i}", 5) for i in range(10)}
