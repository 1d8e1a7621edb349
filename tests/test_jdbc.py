from wardlake.sources.tables import jdbc_options

PROPS = """connector.name=warehouse
connection-url=jdbc:postgresql://db.example:5439/dev
connection-user=reader
connection-password=secret
"""


def test_jdbc_options_partitioned():
    o = jdbc_options(PROPS, "public.sales", "id", 0, 1000, 16)
    assert o["url"] == "jdbc:postgresql://db.example:5439/dev"
    assert o["user"] == "reader" and o["dbtable"] == "public.sales"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "1000", "16")
