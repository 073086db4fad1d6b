"""Table schemas."""

from pyspark.sql import types as T

S, L, I, D, B, TS, DT = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
                         T.TimestampType(), T.DateType())


def _st(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


REGISTRY = _st(("file_id", L), ("object_key", S), ("version_token", S), ("serial", S), ("filetime", TS),
               ("loopname", S), ("source", S), ("parse_status", S), ("error_text", S), ("device_address", S),
               ("physical_group", S), ("schema_id", S), ("ingested_at", TS))

RECORDS = _st(("file_id", L), ("line_no", I), ("raw_text", S), ("parsed", T.MapType(S, S)), ("label_code", S),
              ("label_name", S), ("record_ts", TS))

READINGS = _st(("serial", S), ("record_ts", TS), ("metric_key", S), ("metric_value", D), ("unit", S),
               ("quality", S), ("source_file_id", L), ("source_system", S), ("error_flag", B), ("low_alarm", B),
               ("high_alarm", B), ("device_address", S), ("physical_group", S))

CHECKPOINT = _st(("object_key", S), ("version_token", S), ("run_id", S), ("processed_at", TS))

SCHEDULE = _st(("ps_code", S), ("group_name", S), ("analyte_number", S), ("analyte_name", S), ("last_sampled", DT),
               ("frequency_months", I), ("next_due_date", DT), ("next_due_raw", S), ("notes", S),
               ("source_file", S), ("imported_at", TS))

ALERT_STATE = _st(("alert_key", S), ("last_sent_at", TS), ("last_payload", S))

# Partials of readings (operators.summary), partitioned by the day of the span.
SUMMARY = _st(("span", TS), ("physical_group", S), ("source_system", S), ("metric_key", S), ("unit", S), ("n", L), ("n_values", L), ("total", D),
              ("last_ts", TS), ("last_serial", S), ("last_file", L), ("last_value", D), ("dt", DT))
