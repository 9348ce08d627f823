"""The registered queries, their inputs and their oracles."""
