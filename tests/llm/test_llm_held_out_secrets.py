"""The two models of op7 on strings that no table holds."""

import base64
import random
import string

from lumenfold.llm import queries, secrets

WORDS = (
    "user account buffer handler request response parse write stream index table column session token cache manager factory "
    "service client server config option default value update delete create insert select filter merge window cluster vector "
    "matrix random string number integer boolean object array length offset pointer thread process signal socket channel"
).split()


def drawn():
    draw = random.Random(11)
    pick = lambda letters, n: "".join(draw.choices(letters, k=n))
    for _ in range(60):
        yield "random", base64.b64encode(draw.randbytes(30)).decode()
        yield "random", base64.b32encode(draw.randbytes(30)).decode()[:32]
        yield "random", pick(string.ascii_letters + string.digits, 20)
        yield "random", pick(string.ascii_lowercase + string.digits, 32)
        words = draw.choices(WORDS, k=draw.randint(3, 5))
        yield "name", "_".join(words)
        yield "name", "_".join(words).upper()
        yield "name", words[0] + "".join(w.title() for w in words[1:])


def test_random_strings_are_found_and_most_names_are_not(spark, folder):
    rows = [(k, kind, f"see {value} there") for k, (kind, value) in enumerate(drawn())]
    texts = spark.createDataFrame(rows, "doc_id long, kind string, text string")
    weights = secrets.train(secrets.samples_of(queries.documents(spark, folder)))
    hits = {}
    for row in secrets.scan(texts, weights).collect():
        hits.setdefault(row["kind"], []).append(bool(row["found"]))
    share = {kind: sum(found) / len(found) for kind, found in hits.items()}
    assert share["random"] >= 0.95
    assert share["name"] <= 0.2  # names in camel case are the hard ones
