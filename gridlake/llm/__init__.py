"""Training-data operators: text in, text, spans, ids or verdicts out, all as Spark jobs."""
