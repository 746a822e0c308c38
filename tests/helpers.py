"""Brute force in plain Python, and a look at executed plans."""

import math
import re
from collections import Counter, defaultdict

REVIEWS = "asin string, reviewText string"
PRICES = "asin string, price string"


def words(text):
    return [w.lower() for w in re.findall(r"[0-9A-Za-z]+", text or "")]


def brute_tfidf(reviews):
    """{(key, word): (tf, df, idf, tfidf)} of (key, text) rows."""
    documents = defaultdict(Counter)
    for key, text in reviews:
        if words(text):
            documents[key].update(words(text))
    frequency = Counter(word for counts in documents.values() for word in counts)
    result = {}
    for key, counts in documents.items():
        if key is None:
            continue
        for word, count in counts.items():
            tf = count / sum(counts.values())
            idf = math.log(len(documents) / frequency[word])
            result[key, word] = (tf, frequency[word], idf, tf * idf)
    return result


def brute_pearson(pairs):
    n = len(pairs)
    mean_x = math.fsum(x for x, _ in pairs) / n
    mean_y = math.fsum(y for _, y in pairs) / n
    xy = math.fsum((x - mean_x) * (y - mean_y) for x, y in pairs)
    xx = math.fsum((x - mean_x) ** 2 for x, _ in pairs)
    yy = math.fsum((y - mean_y) ** 2 for _, y in pairs)
    return xy / math.sqrt(xx * yy)


def plan_of(table):
    """Physical plan as planned, before it runs."""
    return table._jdf.queryExecution().executedPlan().toString()


def executed_nodes(table):
    """Run a query; count the operators that ran by name, each shared one once.

    Scans are named by the last column they read.
    """
    table._jdf.collectToPython()
    found = {}

    def visit(node):
        name = node.nodeName()
        if name.startswith("Reused"):
            return
        if name == "AdaptiveSparkPlan":
            return visit(node.executedPlan())
        if name.endswith("QueryStage"):
            return visit(node.plan())
        scan = name.startswith("Scan")
        found[node.id()] = f"Scan {node.schema().fieldNames()[-1]}" if scan else name
        for below in (node.children(), node.subqueries()):
            for i in range(below.size()):
                visit(below.apply(i))

    visit(table._jdf.queryExecution().executedPlan())
    return Counter(found.values())
