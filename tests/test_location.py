import random
import string

from pyspark.sql import functions as F

from hirelens.functions.location import parse_location
from hirelens.functions.text import place_label, squash_ws, title_case

GOLDEN = [
    ("New York, NY, USA", "New York", "Ny", "Usa", False, 0.6),
    ("Remote - US", "Remote", "Us", None, True, 0.6),
    ("Winston-Salem, NC", "Winston", "Salem", "Nc", False, 0.6),
    ("USA", "Usa", None, None, False, 0.6),
    ("NY", None, "Ny", None, False, 0.6),
    ("éa", None, "Éa", None, False, 0.6),
    ("X", None, None, None, False, 0.3),
    ("42", None, None, None, False, 0.3),
    ("Paris | France", "Paris", None, "France", False, 0.6),
    ("Paris | éa", "Paris", None, "Éa", False, 0.6),
    ("London, UK/Remote", "London", "Uk", "Remote", True, 0.6),
    ("remotely, far", "Remotely", None, "Far", False, 0.6),
    ("a, b, c, d, e", "A", "B", "C", False, 0.6),
    (" , ,\tnew york ,, tx /", "New York", "Tx", None, False, 0.6),
    ("o'fallon", "O'Fallon", None, None, False, 0.6),
    (" , ", None, None, None, False, 0.3),
    ("", None, None, None, False, 0.1),
    (None, None, None, None, False, 0.1),
]
FIELDS = ["location_raw", "city", "state", "country", "is_remote", "confidence"]


def test_golden(spark):
    texts = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, location_raw string")
    got = [tuple(r[f] for f in FIELDS) for r in parse_location(texts).orderBy("i").collect()]
    assert got == GOLDEN


def test_title_case_equals_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(string.ascii_letters + "éßÀž '-1_.", k=rng.randint(0, 14))) for _ in range(400)]
    texts = [t.replace("ß", "s") for t in texts]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", title_case(F.col("t")).alias("c")).collect()
    assert all(r["c"] == r["t"].title() for r in got)


def test_squash_ws_equals_python(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab \t\n\r\x0b\x0c\x1c\x85  　", k=rng.randint(0, 12))) for _ in range(300)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", squash_ws(F.col("t")).alias("c")).collect()
    assert all(r["c"] == " ".join(r["t"].split()) for r in got)


def test_place_label(spark):
    places = [("Remote", None, "Usa"), (None, None, None), (None, "Tx", None), ("A", "B", "C"), (", x ,", "", "")]
    df = spark.createDataFrame(places, "city string, state string, country string")
    got = [r[0] for r in df.select(place_label(F.col("city"), F.col("state"), F.col("country"))).collect()]
    assert got == ["Remote, , Usa", "Unknown", "Tx", "A, B, C", "x"]
