"""lakewarden: certificate-transparency and DNS analytics as Spark jobs."""

__all__ = ["session", "schemas"]
