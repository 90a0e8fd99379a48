"""The periodic refresh as a stream over landed files."""
