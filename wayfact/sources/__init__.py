"""Reading, checking, generating and writing data."""
