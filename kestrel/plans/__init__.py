"""Tag models, their mapping onto the test tables, SQL oracles, job runner."""
