import pytest

from ebbtide.llm.decontaminate import leaks

from .fixtures import empty, odd_rows, table

ITEM = "Alice has 12 apples and gives 5 of them to Bob before the two walk 3 km home, where Bob eats one and Alice keeps the rest."
OTHER = "Maria has 48 apples and gives 9 of them to Igor before the two walk 7 miles home, where Igor eats one and Maria keeps the rest."
TWISTED = "Maria has 48 apples and gives 9 of them to Igor before the two walk 7 miles home, where Olga eats one and Hans keeps the rest."
SHORT = "What is two and two?"
SUMS = "What is 12 + 7 * 3 - 15 / 5 + 9 * 2 - 44 + 8?"
TWICE = (
    "On Monday the baker sold 12 loaves of bread and gave 3 to his neighbour. "
    "On Tuesday the baker sold 15 loaves of bread and gave 4 to his neighbour. How many loaves of bread did he sell in all?"
)
CLEAN = "Nothing here was ever part of any question, though 12 apples and a walk of 3 km do occur to Alice and Bob."


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame(
        [(1, ITEM), (2, SHORT), (3, None), (4, ""), (1, ITEM), (5, SUMS), (6, TWICE), (7, "Why not?")], "item_id long, text string"
    )


def found(docs, benchmark):
    return {(r["doc_id"], r["item_id"]): r for r in leaks(docs, benchmark).collect()}


def test_templates(spark, benchmark):
    filler = "and so the day went on for everyone in the little town " * 5
    rows = [(10, ITEM, None), (11, filler + OTHER + filler, None), (12, CLEAN, None), (13, TWISTED, None)]
    rows += [(14, ITEM.replace(",", " ;"), None), (15, " ".join(ITEM.split()[:7]), None), (16, ITEM + " " + OTHER, None)]
    got = found(table(spark, rows), benchmark)
    assert set(got) == {(10, 1), (11, 1), (14, 1), (16, 1)}
    assert got[10, 1]["n_conflicts"] == 0 and got[11, 1]["n_found"] == got[11, 1]["n_tokens"]
    assert got[11, 1]["n_slots"] > got[11, 1]["n_values"]


def test_every_occurrence_counts(spark, benchmark):
    third = OTHER.replace("48", "31").replace("Maria", "Greta")
    inserted = ITEM.replace("walk 3 km", "slowly walk 3 km").replace("eats one", "eats only one")
    other_days = TWICE.replace("12", "77").replace("Monday", "Friday").replace("15", "21").replace("Tuesday", "Sunday")
    rows = [(20, f"{ITEM} {OTHER}", None), (21, f"{OTHER} and {third}", None), (22, TWICE, None), (23, f"So: {SHORT} Yes.", None)]
    rows += [(24, f"It says {SUMS} there", None), (25, inserted, None), (26, other_days, None), (27, "Why not?", None)]
    clean = [(30, CLEAN, None), (31, "Why not? Because nobody asked.", None), (32, "What is 12 and 7 to you, or 44?", None)]
    clean += [(33, "He asked what two and two make", None), (34, TWISTED, None)]
    got = set(found(table(spark, rows + clean).repartition(4), benchmark))
    assert got == {(20, 1), (21, 1), (22, 6), (23, 2), (24, 5), (25, 1), (26, 6), (27, 7)}


def test_odd_rows(spark, benchmark):
    docs = table(spark, odd_rows())
    assert found(docs, benchmark) == {}
    assert found(empty(spark), benchmark) == {}
    assert found(docs, benchmark.where("item_id > 9")) == {}
    twice = table(spark, [(None, ITEM, None), (7, ITEM, None), (7, ITEM, None), (7, CLEAN, None)])
    assert sorted(map(str, found(twice, benchmark))) == ["(7, 1)", "(None, 1)"]
