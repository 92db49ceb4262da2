"""Raw inputs: seed readers, the test-fixture mapping, schemas and sinks."""
