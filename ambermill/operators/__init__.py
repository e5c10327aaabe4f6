"""ambermill.operators"""
