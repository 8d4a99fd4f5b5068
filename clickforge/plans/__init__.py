"""Plans: the feature-preparation plan over the fixture, the registered queries and their oracles."""
