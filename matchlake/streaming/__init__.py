"""The streaming form of the facts job."""
