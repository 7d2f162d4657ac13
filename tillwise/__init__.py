"""tillwise: payment-transaction analytics as DataFrame -> DataFrame operators."""
