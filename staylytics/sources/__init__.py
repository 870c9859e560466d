"""Raw inputs: bronze schemas, file readers, sinks, and the test-table adapter."""
