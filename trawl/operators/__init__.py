"""DataFrame operators: documents, postings, matching, ranking, maintenance."""
