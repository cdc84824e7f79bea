"""roadcast.operators"""
