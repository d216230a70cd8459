"""The whole job: sources to dataset."""
