"""Landing files, versioned tables, sync state and the demo billing source."""
