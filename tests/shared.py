"""What several test modules use."""

SF = "/root/testdata/sf0.001"


def rows_of(pdf):
    """Rows of a pandas frame in an order-free, type-tolerant form, columns by name."""
    pdf = pdf[sorted(pdf.columns)]
    return sorted(tuple(str(v) for v in r) for r in pdf.astype(object).where(pdf.notna(), None).values.tolist())
