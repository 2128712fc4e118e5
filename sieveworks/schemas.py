"""Schemas of the relations that pass between stages."""

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMPANY = _struct(("name", S), ("ats", S), ("token", S), ("headcount", I), ("source", S))
LISTING = _struct(("source", S), ("title", S), ("company", S), ("url", S), ("posted_date", S), ("snippet", S), ("tags", T.ArrayType(S)), ("lane", S), ("headcount", I), ("pos", L))
VERDICT = _struct(("id", L), ("verdict", S), ("role_category", S), ("reason", S))
SCORE = _struct(("url", S), ("fit_score", I), ("rationale", S))
SEEN = _struct(("url", S), ("first_seen", S))
STATUS = _struct(("name", S), ("status", S), ("attempts", I), ("count", L), ("error", S))
JUDGED = _struct(("chunk", L), ("id", L), ("verdict", S), ("role_category", S), ("reason", S), ("resp_pos", I), ("error", S))
SCORED = _struct(("lane", S), ("url", S), ("fit_score", I), ("rationale", S), ("resp_pos", I), ("error", S))
