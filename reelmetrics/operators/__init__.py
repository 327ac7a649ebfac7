"""DataFrame operators: joins, ordered dedup, aggregates, spam, neighbours, keyphrases, topics."""
